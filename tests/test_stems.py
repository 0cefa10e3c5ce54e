"""Stems of Spanish words, and sentence ranks by them against a walk over the pairs of sentences."""

import numpy as np
from pyspark.sql import functions as F

from lexmill.functions.stem import STOP_WORDS, stem
from lexmill.operators import summarize

KNOWN = "che:che checa:chec checar:chec cheque:chequ chequeo:cheque chiapas:chiap chicos:chic chihuahua:chihuahu chilena:chilen chimenea:chimene torá:tor tórax:torax torcer:torc toreado:tor toreándolo:tor torear:tor torearlo:tor torero:torer tormenta:torment tornado:torn torneos:torne tornillo:tornill torpedearon:torped torpeza:torpez torrencial:torrencial torres:torr torreón:torreon tortilla:tortill rápidamente:rapid nacionalidades:nacional canciones:cancion tecnología:tecnolog presencia:presenci llegue:lleg paguen:pag corriendo:corr a:a y:y"


def test_known_stems(spark):
    known = dict(x.split(":") for x in KNOWN.split())
    df = spark.createDataFrame([(w,) for w in [*known, None, ""]], "w string")
    assert {r["w"]: r["s"] for r in df.select("w", stem(F.col("w")).alias("s")).collect()} == known | {None: None, "": ""}


def test_ranks_by_pairs(spark):
    text = "Los toreros torean toros. El torero y el toro del torneo. Una canción para las canciones. La chica canta canciones al toro. Nada más. Y el de la"
    df = spark.createDataFrame([(1, text), (2, "Solo una frase aquí"), (3, None)], "doc_id long, text string")
    words = {r["pos"]: [*r["w"]] for r in df.where("doc_id = 1").select(F.posexplode(F.split("text", r"\. ")).alias("pos", "s")).select("pos", summarize.sentence_words(F.col("s")).alias("w")).collect()}
    assert words[1] == ["torer", "tor", "torne"] and words[5] == [] and not {*STOP_WORDS} & {w for ws in words.values() for w in ws}
    live = [p for p in words if words[p]]
    held = {w: [p for p in live if w in words[p]] for p in live for w in words[p]}
    step = np.array([[sum(1 / len(words[p]) / len(held[w]) for w in words[p] if w in words[q]) for p in live] for q in live])
    rank = np.full(len(live), 1 / len(live))
    for _ in range(15):
        rank = 0.15 / len(live) + 0.85 * step @ rank
    got = {(r["doc_id"], r["pos"]): r["weight"] for r in summarize.rank_sentences(df).collect()}
    assert got[1, 5] == 0 and np.allclose([got[1, p] for p in live], rank)
