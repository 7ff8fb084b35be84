import numpy as np
from edge import ROWS, documents, empty

from shelflife.llm import langid as L

SF01 = "/root/testdata/sf0.01"


def test_gradients_are_right():
    net = L.Network(["a", "b", "c"], hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 256, (5, 7)), rng.integers(0, 3, 5)
    x[2, 4:] = L.PAD
    _, grads = net.gradients(x, y)
    for k, p in net.p.items():
        spots = [(x[0, 1], 2), (x[1, 3], 7)] if k.startswith("wx") else [(0,) * p.ndim]
        for i in spots:
            p[i] += 1e-4
            up = net.gradients(x, y)[0]
            p[i] -= 2e-4
            down = net.gradients(x, y)[0]
            p[i] += 1e-4
            assert abs((up - down) / 2e-4 - grads[k][i]) < 1e-5


def test_sweeps_equal_the_training_pass():
    """Labels of every byte of a window, from the fast sweeps and from the plain states."""
    net = L.Network(["a", "b", "c"], hidden=4, seed=3)
    text = bytes(range(60, 90))
    x = np.frombuffer(text, np.uint8).astype(np.int64)[None]
    f = np.stack([s[5] for s in net._run(x, "f")])
    b = np.stack([s[5] for s in net._run(x[:, ::-1], "b")])[::-1]
    logits = np.concatenate([f, b], axis=2) @ net.p["wo"] + net.p["bo"]
    prob = np.exp(logits) / np.exp(logits).sum(axis=2, keepdims=True)
    assert np.allclose(net.predict([text])[0], prob.mean(axis=(0, 1)), atol=1e-5)


def test_all_bytes_count_and_padding_does_not():
    net = L.Network(["a", "b"], hidden=4)
    long = b"abc" * 500
    alone = net.predict([long])[0]
    assert np.allclose(net.predict([b"", long, b"x"])[1], alone, atol=1e-6)
    parts = [long[i:i + L.WINDOW] for i in range(0, len(long), L.WINDOW)]
    pooled = sum(net.predict([p])[0] * len(p) for p in parts) / len(long)
    assert np.allclose(alone, pooled, atol=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = L.languages(docs).join(docs.select("doc_id", "lang"), "doc_id")
    row = got.filter("held_out").selectExpr("avg(cast(lang = lang_pred as double)) as hit").first()
    assert row.hit >= 0.97
    assert got.count() == docs.count()
    assert got.filter("score < 0 or score > 1").count() == 0


def test_edges(spark):
    import zlib
    got = L.languages(documents(spark)).collect()
    assert len(got) == len(ROWS)
    for r in got:
        text = next(x[1] for x in ROWS if x[0] == r.doc_id) if r.doc_id is not None else "?"
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2)
        if r.doc_id in (3, 4, 5, 7):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif text != "?":
            assert r.lang_pred in ("en", "fr", "de", "ja") and 0 < r.score <= 1
    kept = L.keep_identified(documents(spark))
    assert kept.columns == documents(spark).columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(
        str(r[0]) for r in ROWS if r[1] and r[0] not in (4, 5, 7))


def test_nothing_labelled(spark):
    from pyspark.sql import functions as F
    docs = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.languages(docs).collect()} == {"und"}
    assert L.languages(empty(spark)).count() == 0


def test_training_texts_are_distinct_whatever_is_copied(spark, monkeypatch):
    from pyspark.sql import functions as F
    got = {}
    monkeypatch.setattr(L.Network, "train", lambda net, texts, labels: got.update(
        {k: sorted(t for t, y in zip(texts, labels) if net.langs[y] == k) for k in net.langs}))
    copies = spark.range(60000).select(F.col("id").alias("doc_id"), F.lit("one text").alias("text"))
    others = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    docs = copies.unionByName(others).withColumn("lang", F.lit("a")).unionByName(
        others.withColumn("lang", F.lit("b")))
    L.fit(docs)
    own = sorted(r.text.encode() for r in others.filter(~L.held_out()).collect())
    assert got == {"a": sorted([b"one text", *own]), "b": own}
    L.fit(docs, 20)
    assert all(5 < len(x) <= 80 and len(set(x)) == len(x) for x in got.values())


def test_the_stage_keeps_texts_when_nothing_is_labelled(spark):
    from pyspark.sql import functions as F
    labelled = documents(spark)
    kept = L.keep_identified(labelled.withColumn("lang", F.lit(None).cast("string")))
    assert kept.columns == labelled.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(
        str(r[0]) for r in ROWS if r[1] and r[0] not in (4, 5, 7))
    assert L.keep_identified(empty(spark)).count() == 0
