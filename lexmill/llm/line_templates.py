"""Line deduplication with a log-template tree of fixed depth.

A line's words that look variable (digits, addresses) become ``<*>``. Its path in the tree
is its number of words, then its first ``DEPTH`` words, which end in a leaf. A leaf parts its
lines in further levels. Of each level the template has, at every place, the word that
most of the leaf's lines left have there, if in ``MIN_DOCS`` documents at least, else ``<*>``. A line that
agrees with it in the share ``ALIKE`` of its places is of this template and leaves; the others go
down a level. From the second level on the template is that of the lines that share an anchor: the
word and place that most lines have, of those that at most half of them have, so that families
of lines in one leaf part. A leaf has as many levels as name lines: after the first it ends at one that
names none, as the next would be the same. No step looks at how many lines there are, or at their order: all
are counts by leaf, place and word, so a leaf of any size is dealt to many tasks.

Templates that recur in ``MIN_DOCS`` documents or more, or in ``LONG_DOCS`` where they have
over ``LONG`` words, are dropped; with ``keep_first`` not from the document with the least
id that has them, so that what near copies share stays once. A line without a template is
one of its own. Whole-text copies count as one document, so a text is not emptied for being
copied. Only leaves that recur and hold two different lines or more need words; of the others
hashes suffice.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, join_skewed, small_batches, table, tidy

DEPTH, ALIKE, MIN_DOCS = 3, 0.7, 3
#: Levels whose names are written together, so that a plan reads few tables however many levels there are.
FOLDED = 8
#: Lines of over so many words are passages: it takes fewer documents to drop them.
LONG, LONG_DOCS = 50, 2
VARIABLE = re.compile(r"[0-9]|@|://")


def masked(line: str) -> list[bytes]:
    """The words of a line, ASCII blanks apart, with ``<*>`` for the variable ones."""
    words = line.encode().split()
    if VARIABLE.search(line):
        return [b"<*>" if VARIABLE.search(w.decode()) else w for w in words]
    return words


def lines_of(docs: DataFrame) -> DataFrame:
    """A row per line that has a word: place, doc (hash of the whole text), line_no, long (over ``LONG`` words), leaf and line (hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            rows, own, no, long, leaf, line = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                if not text:
                    continue
                doc = digest(text.encode())
                for k, part in enumerate(text.split("\n")):
                    words = masked(part)
                    if words:
                        rows.append(i)
                        own.append(doc)
                        no.append(k)
                        long.append(len(words) > LONG)
                        leaf.append(digest(b" ".join([b"%d" % len(words), *words[:DEPTH]])))
                        line.append(digest(b" ".join(words)))
            longs = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (own, leaf, line)]
            yield pa.RecordBatch.from_arrays([batch.column("place").take(pa.array(rows, pa.int64())), pa.array(no, pa.int32()), pa.array(long, pa.bool_()), *longs], ["place", "line_no", "long", "doc", "leaf", "line"])

    return docs.select("place", "text").mapInArrow(tidy(run), "place struct<absent:boolean,id:long,key:long>, line_no int, long boolean, doc long, leaf long, line long")


def word_ids(words: list[bytes]) -> np.ndarray:
    return np.array([0 if w == b"<*>" else xxhash.xxh64_intdigest(w) or 1 for w in words], dtype=np.uint64)


def recurring(min_docs: int) -> Column:
    """Whether ``n`` documents are enough."""
    return F.col("n") >= F.when(F.col("long"), min(LONG_DOCS, min_docs)).otherwise(min_docs)


def worded(docs: DataFrame, lines: DataFrame, min_docs: int) -> DataFrame:
    """leaf, line, n (its documents) and words of the different lines of every leaf that has several and may recur."""
    each = lines.groupBy("leaf", "line", "long", "doc").agg(F.min(F.struct("place", "line_no")).alias("witness"))
    distinct = cut(each.groupBy("leaf", "line", "long").agg(F.count("*").alias("n"), F.min("witness").alias("witness")), "template-lines")
    several = distinct.groupBy("leaf", "long").agg(F.count("*").alias("size"), F.sum("n").alias("n")).where((F.col("size") > 1) & recurring(min_docs))
    wanted = join_skewed(distinct, several.select("leaf", "size"), "leaf", "size", distinct.count()).select("witness.place", F.struct("witness.line_no", "leaf", "n", "line").alias("want"))
    wanted = wanted.groupBy("place").agg(F.collect_list("want").alias("wants"))  # at most a document's lines

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for text, wants in zip(batch.column("text").to_pylist(), batch.column("wants").to_pylist()):
                parts = text.split("\n")
                for w in wants:
                    words = masked(parts[w["line_no"]]) if w["line_no"] < len(parts) else []
                    if words:
                        rows.append((w["leaf"], w["n"], w["line"]))
                        found.append(word_ids(words).view(np.int64))
            longs = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            ends = np.append(0, np.cumsum([x.size for x in found])).astype(np.int32)
            words = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found) if found else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([*longs, words], ["leaf", "n", "line", "words"])

    return docs.select("place", "text").hint("merge").join(wanted, "place").select("text", "wants").mapInArrow(tidy(pick), "leaf long, n long, line long, words array<long>")


def support(rows: DataFrame) -> DataFrame:
    """leaf, width, pos, word, s: the documents whose lines have a word at a place."""
    parts = rows.select("leaf", "n", F.size("words").alias("width"), F.posexplode("words").alias("pos", "word")).where("word <> 0")
    return parts.groupBy("leaf", "width", "pos", "word").agg(F.sum("n").alias("s"))


def enough(min_docs: int) -> Column:
    return F.col("s") >= F.when(F.col("width") > LONG, min(LONG_DOCS, min_docs)).otherwise(min_docs)


def leading(counts: DataFrame, min_docs: int) -> DataFrame:
    """leaf and ``lead``, the word of most support at each place, 0 for none; only of leaves where so many places have one that a line may agree."""
    best = counts.where(enough(min_docs)).groupBy("leaf", "width", "pos").agg(F.max(F.struct("s", "word"))["word"].alias("word"))
    found = best.groupBy("leaf", "width").agg(F.map_from_entries(F.collect_list(F.struct("pos", "word"))).alias("at"))  # at most a line's places
    found = found.where(F.size("at") >= F.lit(ALIKE) * F.col("width"))
    return found.select("leaf", F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda i: F.coalesce(F.try_element_at("at", i), F.lit(0))).alias("lead"))


def templates(docs: DataFrame, lines: DataFrame, min_docs: int) -> DataFrame:
    """(line, template, n) for the lines that have a template."""
    play = cut(worded(docs, lines, min_docs), "template-words")
    named, live = None, None
    for level in count():
        total = play.count()
        if level and not total:
            return named
        counts, sizes = support(play), play.groupBy("leaf").agg(F.count("*").alias("size"), F.sum("n").alias("all"))
        if level:
            some = cut(counts, "support").where((F.col("pos") >= DEPTH) & enough(min_docs)).join(sizes, "leaf").where(2 * F.col("s") <= F.col("all"))
            some = some if live is None else some.join(live, "leaf", "left_semi")
            anchor = some.groupBy("leaf").agg(F.max(F.struct("s", (-F.col("pos")).alias("back"), "word")).alias("a"), F.first("size").alias("size"))
            anchor = anchor.select("leaf", "size", (-F.col("a.back")).alias("a_pos"), F.col("a.word").alias("a_word"))
            counts = support(join_skewed(play, anchor, "leaf", "size", total).where(F.get("words", F.col("a_pos")) == F.col("a_word")))
        lead = leading(counts, min_docs).join(sizes.drop("all"), "leaf")
        agree = F.size(F.filter(F.zip_with("words", "lead", lambda a, b: (a == b) & (a != 0)), lambda same: same))
        met = join_skewed(play, lead, "leaf", "size", total).withColumn("in", agree >= F.lit(ALIKE) * F.size("words"))
        # A leaf without a leading template has none further down.
        met = cut(met.select("leaf", "n", "line", "words", "in"), "template-level")
        joined = met.where("in").select("line", F.xxhash64("leaf", F.lit(level)).alias("template"), "n")
        named = joined if named is None else named.union(joined)
        if level and joined.isEmpty():
            return named
        if level % FOLDED == FOLDED - 1:
            named = cut(named, "template-names")
        # An anchored level that names none of a leaf's lines would find the same anchor and template again.
        live = met.where("in").select("leaf").distinct() if level else None
        play = met.where("not in").select("leaf", "n", "line", "words")


def drop_templates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, keep_first: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns of ``keep``, ``n_lines``, ``n_dropped`` (lines with a word, and those dropped) and ``text`` without these.

    Lines end at \\n; lines without a word and the order of lines stay. Null texts stay null,
    empty ones empty. A row is told from others by id and text: equal rows fare alike, rows of
    one id with different texts are different documents, null ids come last. Of words of equal
    support the one of the greater hash leads. An empty table gives an empty one; columns that
    ``keep`` does not name are left out, whatever their names.
    Lines of over ``LONG`` words are dropped from ``LONG_DOCS`` documents on, if that is less than ``min_docs``.
    """
    spark = docs.sparkSession
    small_batches(spark, rows=1000, mb=2)
    place = F.struct(F.col(id_col).isNull().alias("absent"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.xxhash64(text_col).alias("key"))
    source = docs.select(F.col(id_col).alias("own_id"), place.alias("place"), F.col(text_col).alias("text"), *(F.col(c).alias(f"kept_{c}") for c in keep))
    lines = cut(lines_of(source), "lines")
    named = cut(templates(source, lines, min_docs), "templates")
    lines, total = lines.select("place", "line_no", "long", "doc", "line"), lines.count()
    lines = join_skewed(lines, named, "line", "n", total, how="left").select("place", "line_no", "long", "doc", F.coalesce("template", "line").alias("template"))
    lines = cut(lines, "templated-lines")
    each = lines.groupBy("template", "long", "doc").agg(F.min("place").alias("place"), F.count("*").alias("rows"))
    often = each.groupBy("template", "long").agg(F.count("*").alias("n"), F.min("place").alias("first"), F.sum("rows").alias("rows")).where(recurring(min_docs))
    gone = join_skewed(lines, often.select("template", "first", "rows"), "template", "rows", total)
    if keep_first:
        gone = gone.where(F.col("place") != F.col("first"))
    gone = gone.groupBy("place").agg(F.collect_set("line_no").alias("gone"))  # at most a document's lines

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, dropped, texts = [], [], []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
                parts = text.split("\n") if text else []
                gone = {*(gone or ())}
                n.append(sum(1 for p in parts if p.encode().split()))
                dropped.append(len(gone))
                texts.append("\n".join(p for k, p in enumerate(parts) if k not in gone) if gone else text)
            yield pa.RecordBatch.from_arrays([batch.column("own_id"), *(batch.column(c) for c in kept), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())], ["own_id", *kept, "n_lines", "n_dropped", "text"])

    kept = [f"kept_{c}" for c in keep]
    given = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in ("own_id", *kept))
    out = source.hint("merge").join(gone, "place", "left").select("own_id", *kept, "text", "gone").mapInArrow(tidy(rebuild), f"{given}, n_lines long, n_dropped long, text string")
    return out.select(F.col("own_id").alias(id_col), *(F.col(f"kept_{c}").alias(c) for c in keep), "n_lines", "n_dropped", "text")


def op8_line_templates(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """How many lines of each document of ``documents`` are dropped, and the digest of what stays."""
    found = drop_templates(table(spark, sf_dir, "documents") if docs is None else docs)
    return found.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("kept_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
