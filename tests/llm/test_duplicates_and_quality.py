"""SimHash, vectors, fingerprints, web archives, quality and the pipeline,
held against brute force, with null, empty, long, repeated and clashing rows."""

import hashlib
import math
import random
import re
import struct

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from recprep.llm import components, embedding_dedup, fingerprints, quality, simhash, warc
from recprep.session import staging_path


def classes(n, links):
    up = list(range(n))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(k) for k in range(n)]


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (7, 6)]
    df = spark.createDataFrame(links + [(None, 3), (3, None)], "x long, y long")
    got = {r.node: r.root for r in components.components(df, "x", "y").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components.components(df.where(F.lit(False)), "x", "y").count() == 0


def brute_fingerprint(text, words=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_rules():
    for t in (None, "", " \t\n", "One", "one two", "ONE two three", "a b c d e f g a b c a b c", "É é  ñ\x0bx\x85y z",
              "w " * 40000):
        assert simhash.fingerprint(t) == brute_fingerprint(t)


def test_near_fingerprints_are_all_found(spark):
    rnd = random.Random(1)
    base = [rnd.getrandbits(64) for _ in range(30)]
    fps = set(base)
    for b in base:
        for bits in (1, 2, 2, 3, 4):
            fps.add(b ^ sum(1 << k for k in rnd.sample(range(64), bits)))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for most in (0, 1, 2, 3):
        got = {(r.a, r.b) for r in simhash.near_fingerprints(df, "fp", most).collect()}
        want = {tuple(sorted((signed[i], signed[j]))) for i in range(len(fps)) for j in range(i)
                if bin(fps[i] ^ fps[j]).count("1") <= most}
        assert got == want


def test_simhash_components(spark):
    rnd = random.Random(2)
    long = [" ".join(rnd.choice("abcdefghij") for _ in range(400)) for _ in range(6)]
    texts = [None, "", " ", "a b c", "A B C", *long, *[t + " z" for t in long], *[t.replace("a", "q", 1) for t in long],
             "x " * 5000]
    rows = [(i * 3 + 5, t, "clash", "x") for i, t in enumerate(texts)] + [(None, "a b c", "", "x"), (8, "", "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, component_id string")
    got = simhash.near_duplicates(df)
    assert got.columns == ["doc_id", "fingerprint", "component_id", "component_key"]
    fps = [brute_fingerprint(r[1]) for r in rows]
    root = classes(len(rows), [(i, j) for i in range(len(rows)) for j in range(i)
                               if bin(fps[i] ^ fps[j]).count("1") <= 2])
    name = {}
    for r, k in zip(rows, root):
        if r[0] is not None:
            name[k] = min(name.get(k, r[0]), r[0])
    want = sorted((str(r[0]), f"{f:016x}", name[k]) for r, f, k in zip(rows, fps, root))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got.collect()) == want
    assert simhash.near_duplicates(df.where(F.lit(False))).count() == 0


@pytest.mark.parametrize("cell", [1024, 16])
def test_vectors_link_as_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(embedding_dedup, "CELL", cell)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 16))
    vectors = [*base, *(base[:25] + 0.08 * rng.standard_normal((25, 16))),
               *(base[0] + 0.15 * rng.standard_normal((40, 16))), base[1], base[1], base[2] * 7]
    labels = [i % 2 for i in range(60)] + [i % 2 for i in range(25)] + [0] * 40 + [1, 1, 0]
    rows = [(i * 2 + 1, [float(x) for x in v], l, "x") for i, (v, l) in enumerate(zip(vectors, labels))]
    odd = [(900, None, 1, "x"), (901, [], 1, "x"), (902, [0.0] * 16, 1, "x"), (903, [float("nan")] + [1.0] * 15, 1, "x"),
           (904, [None] + [1.0] * 15, 1, "x"), (905, [float(x) for x in base[1]], None, "x"),
           (906, [1.0, 2.0], 1, "x"), (907, [float("inf")] + [1.0] * 15, 1, "x")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int, n_links string")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    x = np.array(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = (x @ x.T >= 0.93) & (np.array(labels)[:, None] == np.array(labels)[None, :])
    np.fill_diagonal(near, False)
    root = classes(len(rows), list(zip(*np.nonzero(near))))
    assert len(got) == len(rows) + len(odd)
    for r, n, k in zip(rows, near.sum(axis=1), root):
        assert got[r[0]].n_links == n and got[r[0]].component_id == rows[k][0]
        assert got[r[0]].kept == (rows[k][0] == r[0])
    assert all(got[r[0]].n_links == 0 and got[r[0]].component_id == r[0] for r in odd)
    assert embedding_dedup.near_duplicates(df.where(F.lit(False))).count() == 0


@pytest.mark.parametrize("dim, miss", [(24, 1e-6), (64, 1e-3)])
def test_vectors_of_many_segment_bits_link_as_brute_force(spark, monkeypatch, dim, miss):
    """Several bits per segment, cut buckets, a third of the rows near-equal."""
    monkeypatch.setattr(embedding_dedup, "CELL", 64)
    rng = np.random.default_rng(dim)
    base = rng.standard_normal((700, dim))
    vectors = np.concatenate([base, base[:150] + 0.1 * rng.standard_normal((150, dim)),
                              base[0] + 0.12 * rng.standard_normal((400, dim)),
                              base[5] * np.array([[1e-200], [1e200]]), base[:3]])
    assert embedding_dedup.plan(len(vectors), 0.93, miss)[0] >= 4
    df = spark.createDataFrame([(i, v.tolist(), 7) for i, v in enumerate(vectors)],
                               "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.near_duplicates(df, miss=miss).toPandas().set_index("vec_id").sort_index()
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.93
    np.fill_diagonal(near, False)
    found, links = got.n_links.to_numpy(), near.sum(axis=1)
    assert (found <= links).all() and found.sum() >= 0.995 * links.sum()
    if miss < 1e-5:
        root = classes(len(vectors), list(zip(*np.nonzero(near))))
        assert (found == links).all() and got.component_id.tolist() == list(root)
    assert got.n_links[700 + 150 + 400] >= 2


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(8)
    turn = embedding_dedup.rotation(64, 0)
    assert np.allclose(turn @ turn.T, np.eye(64))
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turned = x @ turn.T
    factor = np.abs(turned).sum(axis=1) / 8
    estimate = turned @ (np.sign(turned) / 8).T / factor
    error = estimate - x @ x.T
    sd = np.sqrt((1 - factor ** 2) / factor ** 2 / 63)
    off = ~np.eye(400, dtype=bool)
    assert abs(error[off].mean()) < 0.003
    assert (np.abs(error) <= embedding_dedup.ERRORS * sd)[off].mean() > 0.9995


def _x64(*values):
    h = 42
    for kind, v in values:
        h = xxhash.xxh64_intdigest(v if kind == "s" else struct.pack("<" + kind, v), h)
    return h - (1 << 64) if h >> 63 else h


def brute_signature(text):
    """The same signature, step by step."""
    units = re.findall(r"[^ \t\n\x0b\f\r]{1,%d}" % fingerprints.UNIT, text)
    if not units:
        return []
    h = [_x64(("s", u.encode())) for u in units]
    grams = [_x64(*[("q", x) for x in h[i:i + fingerprints.K]]) for i in range(len(h))]
    seen, heads = {}, []
    for place, g in enumerate(grams):                 # number repeats in text order
        head = (g & (1 << 64) - 1) >> 25
        o = seen[head] = seen.get(head, -1) + 1
        if o:
            head = (_x64(("q", head), ("i", o)) & (1 << 64) - 1) >> 25
        heads.append(head << 24 | place)
    out = []
    for b in range(fingerprints.BINS):                # permutation b: the hashes from b / BINS on, round the end
        xs = sorted(heads, key=lambda x: (x - (b << 57)) % (1 << 63))
        placed = sorted((x & (1 << 24) - 1, x >> 24) for x in xs[:fingerprints.L])
        v = (b << 57) | (_x64(*[("q", p[1]) for p in placed]) & (1 << 57) - 1)
        out.append(v - (1 << 64) if v >> 63 else v)
    return out


def test_signature_equals_brute_force(spark):
    rnd = random.Random(6)
    texts = ["", " ", "one", "one two", "aire " * 300, "x" * 500, "日本語 😀 ñ",
             *[" ".join(rnd.choice(["ab", "cd", "efghijklmnop", "q"]) for _ in range(rnd.randint(1, 200)))
               for _ in range(12)]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("t", fingerprints.signature(F.col("t")).alias("s")).collect():
        assert r.s == brute_signature(r.t)


def test_swapped_halves_lower_the_likeness_of_short_texts(spark):
    rnd = random.Random(8)
    for words in (10, 20, 40, 80):
        rows = []
        for i in range(40):
            t = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8))) for _ in range(words)]
            rows.append((i, " ".join(t), " ".join(t[words // 2:] + t[:words // 2])))
        df = spark.createDataFrame(rows, "i int, a string, b string")
        near = df.select(fingerprints.likeness(fingerprints.signature(F.col("a")),
                                               fingerprints.signature(F.col("b"))).alias("x"))
        assert near.agg(F.avg("x")).first()[0] < 0.5
        same = df.select(fingerprints.likeness(fingerprints.signature(F.col("a")),
                                               fingerprints.signature(F.col("a"))).alias("x"))
        assert same.agg(F.min("x")).first()[0] == 1.0


def test_rows_of_one_id_are_cut_and_many_ranges_are_cheap(spark):
    rows = [(7 if i % 3 else i, f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        dealt = fingerprints.with_next(df, "doc_id", "text", lambda d: d.withColumn("sig", F.lit(None)))
        order = sorted(rows, key=lambda r: (-r[0], -_x64(("s", r[1].encode()))))
        want = {r[1]: order[(i + 1) % len(order)][1] for i, r in enumerate(order)}
        got = dealt.select("text", "next_text", "range").collect()
        assert len(got) == 3000 and all(want[r.text] == r.next_text for r in got)
        sizes = {}
        for r in got:
            sizes[r.range] = sizes.get(r.range, 0) + 1
        assert max(sizes.values()) < 100
        spark.conf.set("spark.sql.shuffle.partitions", "8000")
        import time
        began = time.time()
        plan = fingerprints.with_next(df, "doc_id", "text", lambda d: d.withColumn("sig", F.lit(None)))
        plan._jdf.queryExecution().optimizedPlan().toString()
        assert time.time() - began < 30
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_edited_texts_follow_the_next_document(spark):
    rnd = random.Random(7)
    for n in (1, 2, 60):
        texts = [None, "", "é😀" * 50, "short"] + [" ".join(str(rnd.randint(0, 99)) for _ in range(rnd.randint(1, 80)))
                                                   for _ in range(n)]
        rows = [(rnd.randint(0, 10 ** 9), t, "x") for t in texts] + [(None, "no id", "x")]
        rows.append(rows[-2])                         # a repeated row
        df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(3)
        got = fingerprints.edited_fingerprints(df).collect()
        order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -_x64(("s", (r[1] or "").encode()))))
        want = []
        for i, r in enumerate(order):
            t, nxt = r[1] or "", order[(i + 1) % len(order)][1] or ""
            e = t[:len(t) - len(t) // 3] + nxt[:len(t) // 3]
            a, b, c = brute_signature(t), brute_signature(e), brute_signature(nxt)

            def like(p, q):
                bins = {x >> 57 for x in p} | {x >> 57 for x in q}
                return len(set(p) & set(q)) / len(bins) if bins else 1.0
            want.append((str(r[0]), len(t), hashlib.sha256(e.encode()).hexdigest(), like(a, b), like(a, c)))
        assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got) == sorted(want)
    same = [r.fingerprint for r in got if r.doc_id == rows[-1][0]]
    assert len(same) == 2 and same[0] == same[1]
    assert fingerprints.edited_fingerprints(df.where(F.lit(False))).count() == 0


def test_archives_round_trip(spark):
    big = "".join(random.Random(9).choice("abc é\r\n") for _ in range(90000))
    rows = [(1, "http://a", "x" * 99, "p"), (2, "http://b", "x" * 99, "p"), (3, None, "y" * 100, "p"),
            (4, "http://d", "y" * 100, "p"), (5, "http://e", big, "p"), (6, "http://e", big, "p"), (7, "u", None, "p"),
            (8, "u", "", "p"), (9, "u\r\nX: y", "WARC/1.1\r\n\r\n\r\n0\r\n\r\n" * 9, "p"), (None, "n", "z" * 200, "p"),
            (5, "http://e", big, "p")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload string").repartition(3)
    path = staging_path(spark, "test-archives")
    warc.write_archives(df, path, segment_bytes=4096, records_per_file=7)
    assert warc.read_records(spark, path).where("type = 'continuation'").count() > 20
    got = warc.read_archives(spark, path).toPandas()
    assert len(got) == len(rows) and got.error.isna().all()
    by = got.groupby("row_id", dropna=False)
    for i, _, text, _ in rows:
        g = got[got.row_id.isna()] if i is None else got[got.row_id == str(i)]
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        assert (g.digest == f"sha256:{digest}").all()
        if i in (4, 6):
            assert list(g.type) == ["revisit"] and list(g.refers_to_row) == [str(i - 1)] and g.payload.isna().all()
            assert g.refers_to.iloc[0] == got[got.row_id == str(i - 1)].record.iloc[0]
        else:
            assert (g.type == "response").all() and all(bytes(p) == (text or "").encode() for p in g.payload)
    assert by.size().max() == 2
    empty = staging_path(spark, "test-archives-empty")
    warc.write_archives(df.where(F.lit(False)), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_broken_archives_are_told(spark):
    whole = warc.chunked(b"abc" * 9000)
    assert warc.unchunked(whole) == b"abc" * 9000
    for bad in (whole[:-9], b"", b"5\r\nab", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(bad)
    first, *rest = warc.page_records(1, "u", b"q" * 20000, hashlib.sha256(b"q" * 20000).hexdigest(), None, "d", 4096)
    path = staging_path(spark, "test-archives-broken")
    value = b"\r\n\r\n".join([first, *rest[1:]]).decode() + "\r\n\r\n"
    spark.createDataFrame([(value,)], "value string").coalesce(1).write.text(path)
    (row,) = warc.read_archives(spark, path).collect()
    assert row.payload is None and "segment" in row.error


def brute_perplexities(train, texts, n=4):
    """Interpolated modified Kneser-Ney, by dictionaries."""
    def grams(t):
        u = ["^"] * (n - 1) + list(t) + ["$"]
        return [tuple(u[i:i + n]) for i in range(len(u) - n + 1)]
    counts = {n: {}}
    for t in train:
        for g in grams(t):
            counts[n][g] = counts[n].get(g, 0) + 1
    for k in range(n - 1, 0, -1):
        counts[k] = {}
        for g in counts[k + 1]:
            counts[k][g[1:]] = counts[k].get(g[1:], 0) + 1
    d = {}
    for k, c in counts.items():
        m = [sum(v == i for v in c.values()) for i in range(5)]
        y = m[1] / (m[1] + 2 * m[2]) if m[1] and m[2] else 0
        d[k] = [0.0] + [max(0, min(i, i - (i + 1) * y * m[i + 1] / m[i])) if y and m[i] and i < 4 and len(m) > i + 1
                        else [0, .5, 1, 1.5][i] for i in (1, 2, 3)]
    totals, left = {}, {}
    for k, c in counts.items():
        for g, v in c.items():
            totals[g[:-1]] = totals.get(g[:-1], 0) + v
            left[g[:-1]] = left.get(g[:-1], 0) + d[k][min(v, 3)]

    def p(g):
        lower = p(g[1:]) if len(g) > 1 else 1 / (len(counts[1]) + 1)
        if g[:-1] not in totals:
            return lower
        v = counts[len(g)].get(g, 0)
        return (max(v - d[len(g)][min(v, 3)], 0) + left[g[:-1]] * lower) / totals[g[:-1]]
    return [math.exp(-sum(math.log(p(g)) for g in grams(t)) / (len(t) + 1)) for t in texts]


def test_perplexity_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quality, "BLOCK_BYTES", 3000)
    rnd = random.Random(10)
    texts = {"en": [" ".join(rnd.choice(["the", "of", "and", "tion", "er"]) for _ in range(rnd.randint(1, 60)))
                    for _ in range(80)],
             "fr": [" ".join(rnd.choice(["le", "que", "été", "ñ"]) for _ in range(40)) for _ in range(50)]}
    rows = [(i, t, lang, "x") for i, (t, lang) in enumerate((t, lang) for lang, ts in texts.items() for t in ts)]
    n = len(rows)
    rows += [(n, None, "en", "x"), (n + 1, "", "en", "x"), (n + 2, "ZZ!! QQ!! XX\u0000", "en", "x"), (n + 3, "abc", None, "x"),
             (n + 4, "abc", "xx", "x"), (None, "the of", "en", "x"), rows[0], (n + 5, "the " * 5000, "en", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string").repartition(3)
    trusted = spark.createDataFrame([(i,) for i in range(n)] + [(3,), (None,)], "doc_id long")
    out = quality.classify(df, trusted)
    assert out.columns == ["doc_id", "text", "lang", "perplexity", "threshold", "kept"]
    got = out.toPandas()
    import zlib
    held = lambda i: zlib.crc32(str(int(i)).encode()) % 5 == 0
    for lang in texts:
        train = [r[1] for r in rows[:n] if r[2] == lang and not held(r[0])]
        train += [rows[0][1]] if lang == "en" and not held(0) else []   # the repeated row counts again
        g = got[got.lang == lang]
        want = brute_perplexities(train, [(t or "").replace("\0", "\ufffd") for t in g.text])
        assert np.allclose(g.perplexity, want, rtol=2e-4)
    assert not got[got.doc_id == n + 2].kept.iloc[0]
    judged = got[got.doc_id.isin([n + 3, n + 4])]
    assert judged.perplexity.isna().all() and judged.kept.all()
    assert len(got) == len(rows) and got[got.doc_id < n].kept.mean() > 0.95
    assert quality.classify(df.where(F.lit(False)), trusted).count() == 0


def test_no_table_of_blocks_is_left_in_the_catalog(spark):
    df = spark.createDataFrame([(i, f"some words {i}", "en") for i in range(20)],
                               "doc_id long, text string, lang string")
    got = quality.classify(df, df.select("doc_id"))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("quality_blocks")]
    assert got.count() == 20


def test_threshold_is_the_quantile_of_held_out_trusted_texts(spark):
    import zlib
    rnd = random.Random(11)
    words = {"en": ["the", "of", "and", "tion", "er"], "fr": ["le", "que", "été", "ñ"]}
    rows = [(i, " ".join(rnd.choice(words[lang]) for _ in range(rnd.randint(5, 60))), lang)
            for i, lang in enumerate(["en", "fr"] * 200)]
    n = len(rows)
    # ordinary characters of the language in another order: not far above the quantile
    rows += [(n + i, "".join(rnd.choice("theofandtioner ") for _ in range(200)), "en") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = quality.classify(df, spark.createDataFrame([(i,) for i in range(n)], "doc_id long")).toPandas()
    for lang in words:
        g = got[(got.lang == lang) & (got.doc_id < n)]
        held = g[g.doc_id.map(lambda i: zlib.crc32(str(int(i)).encode()) % quality.HELD_OUT == 0)]
        want = np.quantile(held.perplexity, quality.QUANTILE, method="inverted_cdf")
        assert np.allclose(got[got.lang == lang].threshold, want)
    assert (got.kept == (got.perplexity <= got.threshold)).all()
    assert not got[got.doc_id >= n].kept.any()


def test_simhash_stage_keeps_one_of_each_group(spark):
    from recprep.llm.queries import simhash_stage
    rows = [(5, "a b c d", "en", "s", 7), (3, "A B C D", "en", "s", 7), (3, "A B C D", "en", "s", 7), (9, "x y z", "en", "s", 5),
            (None, "a b c d", "en", "s", 7), (None, "only here at all", "en", "s", 16),
            (None, "ONLY here at all", "en", "s", 16), (None, "another text without id", "en", "s", 3), (9, "q r s t u", "en", "s", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = simhash_stage(spark, df, "")
    assert got.columns == df.columns
    kept = [(r.doc_id, r.text.lower()) for r in got.collect()]
    assert sorted(kept, key=str) == sorted([(3, "a b c d"), (9, "x y z"), (9, "q r s t u"), (None, "only here at all"),
                                            (None, "another text without id")], key=str)


def test_pipeline_on_planted_rows(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, sf).cache()
        assert after.columns == columns
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in kept.select("doc_id").collect()}, name
        kept = after
    fps = {r.doc_id: brute_fingerprint(r.text) for r in kept.collect()}
    assert not [1 for a in fps for b in fps if a < b and bin(fps[a] ^ fps[b]).count("1") <= 2]
    good = docs.join(spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1"), "doc_id")
    labels = {r.doc_id for r in good.collect()}
    dropped = labels - {r.doc_id for r in corpus_pipeline.STAGES[1][1](
        spark, corpus_pipeline.STAGES[0][1](spark, docs, sf), sf).collect()}
    assert len(dropped) <= 0.03 * len(labels)
    pieces = corpus_pipeline.run(spark, sf).toPandas()
    assert set(pieces.doc_id) == set(fps)
    assert (pieces.groupby("sequence_id").length.sum() <= 1024).all()
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()
    assert isinstance(pieces, pd.DataFrame)
