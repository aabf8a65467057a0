"""Rejection by distance: limits against a brute-force version, unlearned
languages of the Latin script, clean texts that stay."""

import math
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from recprep.llm import language

UNLEARNED = {
    "it": "La riunione si terrà domani mattina alle nove nella sala grande del comune, e tutti i cittadini sono "
          "invitati a partecipare alla discussione sul nuovo progetto per il parco.",
    "pt": "A reunião será realizada amanhã de manhã às nove horas na sala grande da câmara, e todos os cidadãos "
          "estão convidados a participar na discussão sobre o novo projeto para o parque.",
    "nl": "De vergadering vindt morgenochtend om negen uur plaats in de grote zaal van het gemeentehuis, en alle "
          "burgers zijn uitgenodigd om deel te nemen aan de discussie over het nieuwe plan.",
    "sv": "Mötet hålls i morgon bitti klockan nio i kommunens stora sal, och alla medborgare är välkomna att delta "
          "i diskussionen om det nya projektet för parken."}


def test_limits_equal_brute_force():
    rnd = random.Random(3)
    rows = [("aa", rnd.choice([5, 6, 9]), rnd.randint(0, 400) / 1000) for _ in range(3000)]
    rows += [("bb", rnd.choice([6, 7]), rnd.randint(100, 300) / 1000) for _ in range(140)]
    rows += [("cc", 9, 0.7), ("cc", 20, 0.6)]
    counts = {}
    for lang, band, x in rows:
        d = counts.setdefault((lang, band), {})
        d[x] = d.get(x, 0) + 1
    got = language.limits(counts, 0.998)
    for lang in ("aa", "bb", "cc"):
        for band in range(65):
            for own, reach in [(True, 0), (True, 1)] + [(False, r) for r in range(65)]:
                mine = sorted((x for name, b, x in rows if abs(b - band) <= reach and (not own or name == lang)),
                              reverse=True)
                if len(mine) >= 100:
                    break
            assert got[lang, band] == mine[max(1, math.ceil(round(len(mine) * 0.002, 9))) - 1]
    assert language.limits({}) == {}
    assert language.limits({("a", 3): {0.5: 1}})["a", 0] == 0.5


def test_texts_are_measured_by_the_other_half(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choice(["lo", "mira", "ketu", "sano", "pi"]) for _ in range(12)), "aa")
            for i in range(60)]
    df = spark.createDataFrame(rows, "id int, text string, lang string")
    model = language.fit(df)
    halves = [r[0] for r in df.select(language.half_of(F.col("text"))).collect()]
    texts = [r[1] for r in rows]
    apart = model.judge(texts, ["aa"] * len(rows), halves)[3]
    x = language._vectors([language._counts(t) for t in texts], model.idf)
    for half in (0, 1):
        mine = [i for i in range(len(rows)) if halves[i] == half]
        other = np.array(sorted((language._counts(t).tolist() for t, h in zip(texts, halves) if h != half)))
        assert mine and len(other)
        centroids, owner = model.halves[1 - half]
        assert (owner == 0).all()
        for i in mine:
            assert apart[i] == pytest.approx(max(0.0, 1 - float((x[i] @ centroids.T).max())), abs=1e-6)
    assert model.judge(texts[:2], [None, "zz"], halves[:2])[3] == [None, None]
    assert model.predict([None, "", "12"]) == (["und"] * 3, [0.0] * 3)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_unlearned_languages_go_and_clean_texts_stay(spark, sf):
    path = f"/root/testdata/{sf}/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test data")
    docs = spark.read.parquet(path).select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet").toPandas()
    extra = [(-1 - i, text * k, None) for i, (text, k) in enumerate(
        (t, k) for t in UNLEARNED.values() for k in (1, 8))]
    got = language.identify(docs.union(spark.createDataFrame(extra, docs.schema))).toPandas()
    odd = got[got.doc_id < 0]
    assert len(odd) == len(extra) and odd.rejected.all()
    held = got[(got.doc_id >= 0) & got.held_out & got.lang.notna()]
    assert (held.lang == held.lang_pred).mean() >= 0.98
    good = held[held.doc_id.isin(labels[(labels.quality == 1) & (labels.toxic.fillna(0) == 0)].doc_id)]
    assert (~good.rejected).mean() >= 0.99
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in held.doc_id)
    assert got.score.between(0, 1).all()
