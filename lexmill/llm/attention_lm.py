"""Scores of texts from a causal self-attention model of subword ids, beside a word count baseline.

Counts of all words of the training documents give the baseline, the counts of subwords and
of subwords that follow one another. The model has one layer of attention over ``SPAN`` ids:
queries, keys, values and a direct path are rows of tables by id, distances have a bias, and
the output is a softmax in two steps: frequent ids and one for each group of the
others, then those of the group; the rarest go by their counts. Direct path and output start as the best low-rank fit of the
counts; gradients train the rest, and these too, on the windows of all training documents. A hash
of id and text puts each document in one of ``ROUNDS`` rounds. In each round the tasks train
copies of the model side by side, each on its documents of the round, and their mean is the next model.
Texts are read once for both: training and scoring take their ids from one table.

A text is scored in windows of ``SPAN`` ids that overlap by half: each id is scored once, in the
later half of its window, by batches of windows under the causal mask.

The ``LEXICON`` most frequent words travel with the tasks, with their counts; the others of a
text meet their counts in a join, where by this no word is frequent. Names of words are
bounded: longer ones are known by a digest of 128 bits.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import chain, count, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, roomy, small_batches, table, tokenizer_file

#: Words that travel with the tasks, and the longest name of a word in bytes.
LEXICON, LONGEST = 1 << 18, 64
#: Ids that a window reads, and those of them that it scores what follows.
SPAN, STEP = 32, 16
WIDTH = 24
#: Ids with rows of their own, by rank; the first HEAD have outputs in the first softmax, those up to each cut one of the others.
OWN = 1023
RARE, BEGIN = OWN, OWN + 1
HEAD = 31
CUTS = (HEAD, 63, 127, 255, 511, RARE + 1)
GROUPS = len(CUTS) - 1
#: The public piece tokenizer's number of ids and its end of text: fixed values.
PIECES, END = 32_000, 2
ROUNDS = 3
BATCH, RATE = 256, 0.01
#: Windows that are scored at once: what they need stays in the cache.
CHUNK = 128
#: Words beyond the lexicon that a worker remembers the ids of.
MEMO = 1 << 18
BLOCKS = 16


def words_of(text: str | None) -> list[bytes]:
    """The words of a text; only A to Z become small."""
    return (text or "").encode("utf-8", "replace").lower().split()


def name_of(word: bytes) -> bytes:
    """The word, or, where it is long, a blank and its digest: no word holds a blank."""
    return word if len(word) <= LONGEST else b" " + hashlib.blake2b(word, digest_size=16).hexdigest().encode()


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text leaves 2 on division by 7; a null id does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """word (its name), cell and n over all texts: the words, and, in rows without a word, the neighbours in those whose names are digests."""
    small_batches(docs.sparkSession, mb=4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[bytes] = Counter()
        pieces = None
        for batch in batches:
            long: Counter[bytes] = Counter()
            for text in batch.column("text").to_pylist():
                found = words_of(text)
                if max(map(len, found), default=0) > LONGEST:
                    long.update(w for w in found if len(w) > LONGEST)
                    found = map(name_of, found)
                sums.update(found)
            if long:
                pieces = pieces or Pieces(path)
                yield pairs(*neighbours(*pieces([*long]), np.fromiter(long.values(), dtype=np.int64, count=len(long))))
            if len(sums) > 200_000:
                yield given(sums)
                sums = Counter()
        yield given(sums)

    def given(sums: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in sums], pa.string()), pa.nulls(len(sums), pa.int32()), pa.array(sums.values(), pa.int64())], ["word", "cell", "n"])

    def pairs(at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        some, place = np.unique(at, return_inverse=True)
        return pa.RecordBatch.from_arrays([pa.nulls(some.size, pa.string()), pa.array(some, pa.int32()), pa.array(np.bincount(place, weights=n).astype(np.int64))], ["word", "cell", "n"])

    return docs.select("text").mapInArrow(roomy(run), "word string, cell int, n long").groupBy("word", "cell").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> tuple[list[bytes], np.ndarray]:
    """The words whose counts reach the least bound that at most ``most`` reach, and these counts."""
    step = F.floor(8 * F.log2("n")).cast("int")
    sizes = sorted(((r["step"], r["k"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("k")).collect()), reverse=True)  # at most 8 x 63 rows
    reach = np.cumsum([k for _, k in sizes])
    taken = int((reach <= most).sum())
    if not taken:
        return [], np.empty(0, np.int64)
    rows = counts.where(step >= sizes[taken - 1][0]).toArrow()
    return [w.encode() for w in rows["word"].to_pylist()], rows["n"].to_numpy()


class Pieces:
    """Subword ids of words, each alone: a word of the tokenizer's text has a mark before it."""

    def __init__(self, path: str):
        import sentencepiece

        self.encode = sentencepiece.SentencePieceProcessor(model_file=path).encode

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Their ids one after the other, and how many each word has."""
        found = self.encode([w.decode() for w in words]) if words else []
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(sizes.sum())), sizes


def neighbours(flat: np.ndarray, sizes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of ids that follow one another in words, each pair as one number, and its word's ``n``; PIECES stands before and behind a word."""
    sizes, n = sizes[sizes > 0], n[sizes > 0]
    u = np.full(flat.size + sizes.size, PIECES, dtype=np.int64)
    u[np.arange(flat.size) + np.repeat(np.arange(sizes.size), sizes)] = flat
    return np.append(PIECES, u)[:-1] * (PIECES + 1) + u, np.repeat(n, sizes + 1)


def neighbours_of(counts: DataFrame, path: str, add_up: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sums of ``size`` cells over what ``add_up`` makes of neighbours (an id, the next, how often) in all words of ``word_counts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, sums = Pieces(path), np.zeros(size)
        for batch in batches:
            word, n = batch.column("word"), batch.column("n").to_numpy()
            named = word.is_valid().to_numpy(zero_copy_only=False)
            at, times = neighbours(*pieces([w.encode() for w in word.drop_null().to_pylist()]), n[named])
            at, times = np.append(at, batch.column("cell").drop_null().to_numpy()), np.append(times, n[~named])
            sums += add_up(at // (PIECES + 1), at % (PIECES + 1), times)
        yield cells(sums)

    # Words whose names are digests are in the rows of cells.
    return dense(counts.where("word is null or not startswith(word, ' ')").mapInArrow(roomy(run), "cell int, n double"), size)


def piece_counts(counts: DataFrame, path: str) -> np.ndarray:
    """How often each subword stands in the counted words."""
    return neighbours_of(counts, path, lambda _, after, n: np.bincount(after, weights=n, minlength=PIECES + 1)[:PIECES], PIECES)


def follower_counts(counts: DataFrame, path: str, rank: np.ndarray) -> np.ndarray:
    """[a, b]: how often b follows a within the counted words, by rank; the last row and column stand for a word's bounds."""
    n, ranks = OWN + 2, np.append(rank, OWN + 1).astype(np.int64)
    return neighbours_of(counts, path, lambda before, after, k: np.bincount(ranks[before] * n + ranks[after], weights=k, minlength=n * n), n * n).reshape(n, n)


def cells(sums: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(sums)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at])], ["cell", "n"])


def dense(rows: DataFrame, size: int) -> np.ndarray:
    """Summed cells on the driver: ``size`` numbers at most."""
    found, out = rows.groupBy("cell").agg(F.sum("n").alias("n")).toArrow(), np.zeros(size)
    out[found["cell"].to_numpy()] = found["n"].to_numpy()
    return out


class Model:
    """Tables of float32; ``rank`` maps the tokenizer's ids to ranks by count, ``spare`` has the log-probability of a rare id among the rare."""

    SHAPES = {"query": (OWN + 2, WIDTH), "key": (OWN + 2, WIDTH), "value": (OWN + 2, WIDTH), "direct": (OWN + 2, WIDTH), "bias": (SPAN,), "head": (HEAD + GROUPS, WIDTH), "head_bias": (HEAD + GROUPS,), "tail": (RARE + 1 - HEAD, WIDTH), "tail_bias": (RARE + 1 - HEAD,)}
    #: By rank: its column in the first softmax (BEGIN is never asked for).
    COLUMN = np.array([*range(HEAD), *(HEAD + g for g in range(GROUPS) for _ in range(CUTS[g], CUTS[g + 1])), 0], dtype=np.intp)

    def __init__(self, flat: np.ndarray, rank: np.ndarray, spare: np.ndarray):
        self.flat, self.rank, self.spare = flat.astype(np.float32, copy=False), rank, spare
        at = 0
        for name, shape in self.SHAPES.items():
            setattr(self, name, self.flat[at : at + int(np.prod(shape))].reshape(shape))
            at += int(np.prod(shape))

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(s)) for s in cls.SHAPES.values())

    def with_weights(self, flat: np.ndarray) -> Model:
        return Model(flat.copy(), self.rank, self.spare)

    @cached_property
    def ready(self) -> tuple:
        """What scoring reads, side by side: queries and direct paths, keys and values, biases, and the outputs with theirs.

        Direct paths end in a 1, which meets the outputs' biases, values in a 0. The last: whether a logarithm may leave the range of float32, by the tables' norms.
        """
        far = np.arange(STEP)[:, None] + SPAN - STEP - np.arange(SPAN)[None]  # -1 and less ahead of the scored place
        bias = np.where(far < 0, np.float32(-1e9), self.bias[far])
        outputs = [np.ascontiguousarray(np.column_stack([w, c]).T) for w, c in ((self.head, self.head_bias), *((self.tail[CUTS[g] - HEAD : CUTS[g + 1] - HEAD], self.tail_bias[CUTS[g] - HEAD : CUTS[g + 1] - HEAD]) for g in range(GROUPS)))]
        norm = lambda m: np.sqrt(np.einsum("ij,ij->i", m, m).max())
        widest = max(norm(self.query) * norm(self.key) + np.abs(self.bias).max(), (norm(self.value) + norm(self.direct)) * max(norm(self.head), norm(self.tail)) + max(np.abs(self.head_bias).max(), np.abs(self.tail_bias).max()))
        ones = ONES[: len(self.direct)]
        return np.hstack([self.query, self.direct, ones]), np.hstack([self.key, self.value, 0 * ones]), bias, far, outputs, bool(widest > STEEP)

    def forward(self, x: np.ndarray) -> tuple:
        """Log-probability of the last STEP ids of each row of SPAN + 1 ids, 0 for BEGIN, and what gradients need."""
        own, read, bias, far, outputs, steep = self.ready
        x = x.astype(np.intp)
        past, here, target = x[:, :SPAN], x[:, SPAN - STEP : SPAN], x[:, SPAN - STEP + 1 :].ravel()
        qr, kv = own.take(here, 0, mode="clip"), read.take(past, 0, mode="clip")
        q, k, v = qr[..., :WIDTH], kv[..., :WIDTH], kv[..., WIDTH:]
        a = np.matmul(q, k.transpose(0, 2, 1))
        a += bias
        total = exponents(a, steep)
        mixed = np.matmul(a, v)
        mixed /= total
        mixed += qr[..., WIDTH:]
        h = mixed.reshape(-1, WIDTH + 1)
        live = target != BEGIN
        column = self.COLUMN.take(target)
        first, out = self.chosen(h, outputs[0], column, steep)
        out[~live] = 0
        groups = []
        for g in range(GROUPS):
            low = np.flatnonzero(column == HEAD + g)
            at = target[low] - CUTS[g]
            own_h = h.take(low, 0)
            second, more = self.chosen(own_h, outputs[1 + g], at, steep)
            out[low] += more
            groups.append((low, own_h, slice(CUTS[g] - HEAD, CUTS[g + 1] - HEAD), at, second))
        return out, (past, here, q, k, v[..., :WIDTH], a, total, h, live, column, first, groups, far)

    @staticmethod
    def chosen(h: np.ndarray, output: np.ndarray, at: np.ndarray, steep: bool) -> tuple[tuple, np.ndarray]:
        """The softmax times its sums, these, and the logarithm at one column of each row."""
        z = h @ output
        if steep:
            z -= z.max(axis=1, keepdims=True)
        own = z.ravel().take(np.arange(0, z.size, z.shape[1]) + at)
        total = exponents(z, False)
        return (z, total), own - np.log(total[:, 0])

    def gradient(self, x: np.ndarray) -> np.ndarray:
        """Of the mean negative log-probability of the rows of ``x``."""
        _, (past, here, q, k, v, a, total, h, live, column, (first, sum1), groups, far) = self.forward(x)
        g = Model(np.zeros_like(self.flat), self.rank, self.spare)
        weight = np.float32(1 / max(1, live.sum()))
        first /= sum1
        first.ravel()[np.arange(0, first.size, first.shape[1]) + column] -= 1
        first *= (live * weight)[:, None]
        sums = first.T @ h
        g.head[:], g.head_bias[:] = sums[:, :WIDTH], sums[:, WIDTH]
        dh = first @ self.head
        for low, own_h, part, own, (second, sum2) in groups:
            second *= weight / sum2
            second.ravel()[np.arange(0, second.size, second.shape[1]) + own] -= weight
            sums = second.T @ own_h
            g.tail[part], g.tail_bias[part] = sums[:, :WIDTH], sums[:, WIDTH]
            dh[low] += second @ self.tail[part]
        dh = dh.reshape(-1, STEP, WIDTH)
        a /= total
        dv = np.matmul(a.transpose(0, 2, 1), dh)
        da = np.matmul(dh, v.transpose(0, 2, 1))
        da -= np.einsum("bij,bij->bi", da, a)[..., None]
        da *= a
        scatter((g.query, g.direct), here.ravel(), np.concatenate([np.matmul(da, k), dh], axis=2))
        scatter((g.key, g.value), past.ravel(), np.concatenate([np.matmul(da.transpose(0, 2, 1), q), dv], axis=2))
        near = far >= 0
        g.bias[:] = np.bincount(far[near], weights=da.sum(axis=0)[near], minlength=SPAN)
        return g.flat

    def trained(self, rows: Iterator[np.ndarray]) -> tuple[np.ndarray, int]:
        """Weights after a step (Adam) for every BATCH windows of ``rows``, and the number of windows."""
        own = self.with_weights(self.flat)
        mean, square, step, n, seen = np.zeros_like(own.flat), np.zeros_like(own.flat), np.empty_like(own.flat), 0, 0
        for x in rows:
            for at in range(0, len(x), BATCH):
                g = own.gradient(x[at : at + BATCH])
                n += 1
                # In place: RATE * (mean / (1 - 0.9**n)) / (sqrt(square / (1 - 0.99**n)) + 1e-6)
                mean *= 0.9
                mean += np.multiply(g, 0.1, out=step)
                square *= 0.99
                square += np.multiply(np.multiply(g, g, out=g), 0.01, out=step)
                np.sqrt(np.multiply(square, 1 / (1 - 0.99**n), out=step), out=step)
                step += 1e-6
                np.divide(mean, step, out=step)
                step *= RATE / (1 - 0.9**n)
                own.flat -= step
                own.__dict__.pop("ready", None)
            seen += len(x)
        return own.flat, seen


ONES = np.ones((SPAN + RARE + 1, 1), dtype=np.float32)
#: Logarithms beyond this do not go through float32 as they are.
STEEP = 60


def exponents(z: np.ndarray, steep: bool) -> np.ndarray:
    """``z`` becomes its exponents, where ``steep`` less each row's greatest; their sums along the last axis."""
    if steep:
        z -= z.max(axis=-1, keepdims=True)
    np.exp(z, out=z)
    return (z.reshape(-1, z.shape[-1]) @ ONES[: z.shape[-1]]).reshape(*z.shape[:-1], 1)


def scatter(to: tuple[np.ndarray, ...], at: np.ndarray, rows: np.ndarray) -> None:
    """Rows added up at their places of small tables, which stand side by side in ``rows``."""
    order = np.argsort(at.astype(np.int16), kind="stable")
    starts = np.flatnonzero(np.diff(at[order], prepend=-1))
    sums = np.add.reduceat(rows.reshape(at.size, -1).take(order, 0), starts, axis=0)
    for table, part in zip(to, np.split(sums, len(to), axis=1)):
        table[at[order[starts]]] = part


def started(uni: np.ndarray, after: np.ndarray, rank: np.ndarray, spare: np.ndarray, n_docs: int) -> Model:
    """The model whose direct path and output fit the counts of neighbours; queries, keys and values are small and random."""
    edge = OWN + 1
    first, words = after[edge, : OWN + 1], after[:, edge].sum()
    stop = (n_docs + 0.5) / (words + n_docs + 1)
    begin = first / max(1, first.sum()) * (1 - stop)
    begin[rank[END]] += stop
    moves = np.zeros((OWN + 2, OWN + 1))
    moves[: OWN + 1] = after[: OWN + 1, : OWN + 1] + after[: OWN + 1, edge, None] * begin
    moves[BEGIN] = max(1, n_docs) * begin
    share = np.bincount(rank, weights=uni, minlength=OWN + 1)[: OWN + 1] + 0.5
    share /= share.sum()
    of = lambda m: np.stack([m[..., CUTS[g] : CUTS[g + 1]].sum(axis=-1) for g in range(GROUPS)], axis=-1)
    both, share = np.column_stack([moves, of(moves)]), np.append(share, of(share))  # the last columns: the groups
    total = moves.sum(axis=1, keepdims=True)
    gain = np.log((both + 5 * share) / (total + 5) / share).clip(-6, 6)
    left, right = np.sqrt(total + 1), np.sqrt(share)
    u, s, v = np.linalg.svd(gain * left * right)
    size = np.sqrt(s[:WIDTH])
    scale = np.sqrt(left.mean() / right.mean())  # both tables of like size
    rng = np.random.default_rng(7)
    model = Model(np.zeros(Model.size()), rank, spare)
    model.direct[:] = u[:, :WIDTH] * size / left * scale
    out = (v[:WIDTH].T * size) / right[:, None] / scale
    model.head[:], model.tail[:] = np.concatenate([out[:HEAD], out[OWN + 1 :]]), out[HEAD : OWN + 1]
    model.head_bias[:], model.tail_bias[:] = np.log(np.append(share[:HEAD], share[OWN + 1 :])), np.log(share[HEAD : OWN + 1])
    for part in (model.query, model.key, model.value):
        part[:] = rng.normal(0, 0.1, part.shape)
    return model


class Lexicon:
    """Frequent words with their counts, and the ids of any words; others are numbered behind them and remembered for a while."""

    def __init__(self, names: list[bytes], counts: np.ndarray, path: str):
        self.top = {w: i for i, w in enumerate(names)}
        self.pieces = Pieces(path)
        # Names that are digests are met by the way of other words.
        self.first = (*self.pieces([w if w[:1] != b" " else b"" for w in names]), counts)
        self.forget()

    def forget(self) -> None:
        self.index = self.top.copy()
        #: Ids of all known words, how many each has, and counts, -1 where only the join tells.
        self.flat, self.sizes, self.counts = self.first
        self.others: list[bytes] = []

    def learn(self, words: list[bytes]) -> None:
        """Number words behind those known."""
        self.index.update(zip(words, count(len(self.index))))
        names = [name_of(w) for w in words]
        known = [self.top.get(n, -1) if n[:1] == b" " else -1 for n in names]
        flat, sizes = self.pieces(words)
        self.flat, self.sizes = np.append(self.flat, flat), np.append(self.sizes, sizes)
        self.counts = np.append(self.counts, [self.first[2][k] if k >= 0 else -1 for k in known]).astype(np.int64)
        self.others += names

    def read(self, texts: list[str | None]) -> Read:
        if len(self.others) > MEMO:
            self.forget()
        return Read(self, texts)


#: The lexicon of a Python worker, which serves many tasks, and the name it was shared under.
KEPT: dict[str, Lexicon] = {}


def lexicon_of(shared, path: str) -> Lexicon:
    """The lexicon of a broadcast (name, words, counts); a worker builds it once."""
    name, words, counts = shared.value
    if name not in KEPT:
        KEPT.clear()
        KEPT[name] = Lexicon(words, counts, path)
    return KEPT[name]


class Read:
    """A batch of texts: words by their number in the lexicon, and subword ids."""

    def __init__(self, lex: Lexicon, texts: list[str | None]):
        words: list[bytes] = []
        sizes = []
        for text in texts:
            found = words_of(text)
            words += found
            sizes.append(len(found))
        self.sizes, self.base = np.array(sizes, dtype=np.int64), len(lex.top)
        self.number = np.fromiter(map(lex.index.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        fresh = np.flatnonzero(self.number < 0)
        new: defaultdict[bytes, int] = defaultdict(count(len(lex.index)).__next__)
        self.number[fresh] = np.fromiter(map(new.__getitem__, [words[i] for i in fresh]), dtype=np.int64, count=fresh.size)
        if new:
            lex.learn(list(new))
        self.others, self.counts = lex.others, lex.counts
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)
        starts = np.cumsum(lex.sizes) - lex.sizes
        own = lex.sizes[self.number]
        ends = np.cumsum(own)
        self.ids = lex.flat[np.repeat(starts[self.number] - (ends - own), own) + np.arange(int(ends[-1]) if ends.size else 0)]
        self.id_sizes = np.bincount(self.doc, weights=own, minlength=len(texts)).astype(np.int64)

    def rare(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, place in ``others`` and frequency of each text's words whose counts are not known here."""
        at = np.flatnonzero(self.counts[self.number] < 0)
        key, tf = np.unique(self.doc[at] * max(1, len(self.others)) + self.number[at] - self.base, return_counts=True)
        return key // max(1, len(self.others)), key % max(1, len(self.others)), tf

    def spare(self, spare: np.ndarray) -> np.ndarray:
        """What ``spare`` adds up to over the ids and the end of every text."""
        return np.bincount(np.repeat(np.arange(self.sizes.size), self.id_sizes), weights=spare[self.ids], minlength=self.sizes.size) + spare[END]

    def scores(self, model: Model) -> np.ndarray:
        """Natural logarithm of every text's probability."""
        return sums_of(model, model.rank[self.ids], self.id_sizes) + self.spare(model.spare)


def windows(ranks: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of SPAN + 1 ranks, each id and the end of each text once among the last STEP; and each row's text."""
    rows = sizes // STEP + 1  # with the end of text
    start = np.cumsum(SPAN - STEP + 1 + STEP * rows)
    u = np.full(int(start[-1]) if start.size else 0, BEGIN, dtype=np.int16)
    start -= SPAN - STEP + 1 + STEP * rows
    place = start + SPAN - STEP + 1
    before = np.cumsum(sizes) - sizes
    u[np.repeat(place - before, sizes) + np.arange(ranks.size)] = ranks
    u[place + sizes] = end
    doc = np.repeat(np.arange(rows.size), rows)
    first = np.repeat(start, rows) + STEP * (np.arange(doc.size) - np.repeat(np.cumsum(rows) - rows, rows))
    if not doc.size:
        return np.empty((0, SPAN + 1), np.int16), doc
    return np.lib.stride_tricks.sliding_window_view(u, SPAN + 1)[first], doc


def sums_of(model: Model, ranks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of every text's ranks."""
    x, doc = windows(ranks, sizes, model.rank[END])
    sums = np.zeros(len(x))
    for at in range(0, len(x), CHUNK):
        part = x[at : at + CHUNK].astype(np.int32)
        sums[at : at + CHUNK] = model.forward(part)[0].reshape(len(part), STEP).sum(axis=1, dtype=np.float64)
    return np.bincount(doc, weights=sums, minlength=sizes.size)


def encoded(docs: DataFrame, model: Model, lexicon, path: str, *, id_col: str = "key", text_col: str = "text") -> DataFrame:
    """Every text read once: key, row, the round that trains on it, what is known of its words and its subwords' ranks.

    n_tokens has the end of text, n_known and part (log10 of counts and 1) have not; ``rare`` lists the words whose
    counts only the join tells, ``spare`` is the model's share that no training changes, ``ids`` has two bytes a rank.
    """
    spark = docs.sparkSession
    small_batches(spark, rows=1000, mb=4)
    shared = spark.sparkContext.broadcast((model.rank, model.spare))
    rare = pa.struct([("word", pa.string()), ("tf", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, (rank, spare) = lexicon_of(lexicon, path), shared.value
        for batch in batches:
            got = lex.read(batch.column("text").to_pylist())
            n = got.sizes.size
            c = np.maximum(got.counts, 0)[got.number]
            part = np.bincount(got.doc, weights=np.log10(c + 1), minlength=n).astype(np.float64)  # integers where no text has words
            known = np.bincount(got.doc, weights=c > 0, minlength=n).astype(np.int64)
            text, other, tf = got.rare()
            ends = np.cumsum(np.bincount(text, minlength=n))
            names = pa.array([w.decode() for w in got.others], pa.string()).take(pa.array(other))
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.StructArray.from_arrays([names, pa.array(tf, pa.int32())], fields=[*rare]))
            places = pa.array(np.append(0, 2 * np.cumsum(got.id_sizes)), pa.int32())
            ids = pa.Array.from_buffers(pa.binary(), n, [None, places.buffers()[1], pa.py_buffer(rank[got.ids].tobytes())])
            columns = [batch.column("key"), batch.column("row"), batch.column("turn"), pa.array(got.sizes + 1, pa.int64()), pa.array(known, pa.int64()), pa.array(part), pa.array(got.spare(spare)), lists, ids]
            yield pa.RecordBatch.from_arrays(columns, ["key", "row", "turn", "n_tokens", "n_known", "part", "spare", "rare", "ids"])

    turn = F.pmod(F.xxhash64(id_col, text_col), F.lit(ROUNDS)).cast("int")
    source = docs.select(F.col(id_col).alias("key"), F.monotonically_increasing_id().alias("row"), turn.alias("turn"), F.col(text_col).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return cut(source.mapInArrow(roomy(run), f"key {kind}, row long, turn int, n_tokens long, n_known long, part double, spare double, rare array<struct<word:string,tf:int>>, ids binary"), "encoded")


def ranks_of(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ranks of a batch of texts, one after the other, and how many each has."""
    parts = ids.to_pylist()
    return np.frombuffer(b"".join(parts), dtype=np.int16), np.array([len(p) // 2 for p in parts], dtype=np.int64)


def train(training: DataFrame, model: Model, lexicon, path: str) -> Model:
    """The model after ROUNDS rounds over the windows of all texts (key, text, or encoded): each text is in one round, in the shard where it lies."""
    spark = training.sparkSession
    rows = training if "ids" in training.columns else encoded(training, model, lexicon, path)
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)

        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rng = np.random.default_rng(11)

            def parts() -> Iterator[np.ndarray]:
                for batch in batches:
                    x, _ = windows(*ranks_of(batch.column("ids")), shared.value.rank[END])
                    order = rng.permutation(len(x))
                    for at in range(0, len(x), BATCH):
                        yield x[order[at : at + BATCH]].astype(np.int32)

            flat, n = shared.value.trained(parts())
            if n:
                yield blocks(flat.astype(np.float64) * n, n)

        fitted = rows.where(F.col("turn") == turn).select("ids").mapInArrow(roomy(fit), "block int, sums binary, n long")
        sums, n = np.zeros(Model.size()), 0
        for row in fitted.repartition(BLOCKS, "block").mapInArrow(added, "block int, sums binary, n long").collect():  # a row per block and task
            part = np.frombuffer(row["sums"])
            at = row["block"] * -(-sums.size // BLOCKS)
            sums[at : at + part.size] += part
            n += row["n"] if row["block"] == 0 else 0
        model = model.with_weights(sums / n) if n else model
    return model


def blocks(flat: np.ndarray, n: int) -> pa.RecordBatch:
    step = -(-flat.size // BLOCKS)
    return pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([flat[i * step : (i + 1) * step].tobytes() for i in range(BLOCKS)], pa.binary()), pa.array([n] * BLOCKS, pa.int64())], ["block", "sums", "n"])


def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of models by block."""
    sums: dict[int, list] = {}
    for batch in batches:
        for block, part, n in zip(*(batch.column(c).to_pylist() for c in ("block", "sums", "n"))):
            if block in sums:
                sums[block][0] += np.frombuffer(part)
                sums[block][1] += n
            else:
                sums[block] = [np.frombuffer(part).copy(), n]
    yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int32()), pa.array([x.tobytes() for x, _ in sums.values()], pa.binary()), pa.array([n for _, n in sums.values()], pa.int64())], ["block", "sums", "n"])


def counted(training: DataFrame, path: str, *, lexicon: int = LEXICON) -> tuple[Model, DataFrame, tuple, dict]:
    """The model as counts start it, the counts of words, the frequent ones, and docs, tokens and distinct (the ends of texts among both) of ``training`` (key, text)."""
    spark = training.sparkSession
    found = cut(word_counts(training, path), "word-counts")
    counts = found.where("word is not null").select("word", "n")
    n_docs = training.count()
    words, n = counts.agg(F.count("*"), F.sum("n")).first()
    names, own = frequent(counts, lexicon)
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, names, own))
    small_batches(spark, rows=20_000, mb=4)
    uni = piece_counts(found, path)
    uni[END] = n_docs
    order = np.lexsort((np.arange(PIECES), -uni))
    rank = np.full(PIECES, RARE, dtype=np.int16)
    rank[order[:OWN]] = np.arange(OWN)
    spare = np.where(rank == RARE, np.log((uni + 0.5) / ((uni + 0.5)[rank == RARE].sum())), 0.0)
    model = started(uni, follower_counts(found, path, rank), rank, spare, n_docs)
    return model, counts, shared, {"docs": n_docs, "tokens": (n or 0) + n_docs, "distinct": words + (n_docs > 0)}


def learn(training: DataFrame, path: str, *, lexicon: int = LEXICON) -> tuple[Model, DataFrame, tuple, dict]:
    """What ``counted`` gives of ``training`` (key, text), its model trained."""
    model, counts, shared, sums = counted(training, path, lexicon=lexicon)
    return train(training, model, shared, path), counts, shared, sums


def score_texts(docs: DataFrame, learned: tuple, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_tokens, n_known, base_score and score of every row.

    A null text is an empty one: its end is its only token. Repeated rows stay, rows of one id
    are scored apart, other columns are ignored, an empty table gives an empty one.
    """
    model, _, lexicon, _ = learned
    return scored(encoded(docs, model, lexicon, path, id_col=id_col, text_col=text_col), learned).withColumnRenamed("key", id_col)


def scored(rows: DataFrame, learned: tuple) -> DataFrame:
    """``score_texts`` of what ``encoded`` gives, by its key."""
    model, counts, _, sums = learned
    spark = rows.sparkSession
    small_batches(spark, rows=1000, mb=4)
    shared = spark.sparkContext.broadcast(model)
    columns = ["key", "row", "n_tokens", "n_known", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = (sums_of(shared.value, *ranks_of(batch.column("ids"))) + batch.column("spare").to_numpy()) / np.log(10)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(score)], [*columns, "score"])

    kind = rows.schema["key"].dataType.simpleString()
    found = cut(rows.select(*columns, "spare", "ids").mapInArrow(roomy(run), f"key {kind}, row long, n_tokens long, n_known long, part double, score double"), "scored")
    met = rows.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.tf").join(counts, "word")
    more = met.groupBy("row").agg(F.sum("tf").alias("more"), F.sum(F.col("tf") * F.log10(F.col("n") + 1)).alias("sum"))
    all_of = float(np.log10(sums["tokens"] + sums["distinct"] + 1))
    both = found.join(more, "row", "left")
    end, known_end = float(np.log10(sums["docs"] + 1)), int(sums["docs"] > 0)
    known = F.col("n_known") + F.coalesce("more", F.lit(0)) + known_end
    base = F.col("part") + end + F.coalesce("sum", F.lit(0.0)) - F.col("n_tokens") * all_of
    return both.select("key", "n_tokens", known.alias("n_known"), base.alias("base_score"), "score")


def op13_attention_scores(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Scores of every text of ``documents``, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    path = tokenizer_file("piece_bpe_32k.model")
    model, *learned = counted(docs.where(~held_out("doc_id")).select(F.col("doc_id").alias("key"), "text"), path)
    rows = encoded(docs, model, learned[1], path, id_col="doc_id")
    model = train(rows.where(~held_out("key")), model, learned[1], path)
    found = scored(rows, (model, *learned)).withColumnRenamed("key", "doc_id")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "n_tokens", "n_known", F.lit(learned[2]["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")
