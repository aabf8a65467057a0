"""Spelling variants, token alignment and toxicity, held against brute force
and held-out accuracy, with null, empty, long, repeated and clashing rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from recprep.llm import queries, spelling, token_alignment, toxicity
from tests.conftest import SF_SMALL
from tests.llm.conftest import vocabulary


# spelling variants

def brute_counts(rows, least=7, drop=31):
    n = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if drop and h % drop == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= least:
                n[w] += 1
    return {w: k for w, k in n.items() if k >= 2}


def one_edit(a, b):
    """Every word at one edit from a, by trial."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_variants(n, ratio=10):
    near = defaultdict(set)
    deleted = defaultdict(set)                        # words one deletion away, to try fewer pairs
    for w in n:
        for i in range(len(w)):
            deleted[w[:i] + w[i + 1:]].add(w)
        deleted[w].add(w)
    for group in deleted.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= ratio * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {w: (form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def as_dict(df):
    got = df.collect()
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert len({r.word for r in got}) == len(got)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


def test_op11_equals_brute_force_on_whole_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet")
            .select("doc_id", "text").collect()]
    want = brute_variants(brute_counts(rows))
    assert as_dict(queries.op11_spelling_variants(spark, SF_SMALL)) == want
    assert any(v[0] for v in want.values()) and any(v[3] > 1 for v in want.values())


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_variants_of_random_words(spark, block, monkeypatch):
    """Few letters, so that groups are hot, in blocks of any size; words of one
    code point, very long words, code points past one and two bytes."""
    rnd = random.Random(block)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 7))) for _ in range(150)}
    words |= {"x" * 3000 + c for c in "abc"} | {"x" * 3001 + "a", "ÿab", "ÿaab", "日ab", "😀ab", "\0ab", "ab"}
    n = {w: rnd.choice([1, 2, 10, 11, 100, 1000]) for w in words}
    df = spark.createDataFrame(list(n.items()) + [(None, 5)], "word string, n long")
    assert as_dict(spelling.spelling_variants(df, block=block)) == brute_variants(n)


def test_chains_end_at_their_root(spark):
    # ten to the power of the length: each word's form is one longer
    n = {"a" * k: 10 ** k for k in range(1, 17)}
    got = as_dict(spelling.spelling_variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == brute_variants(n) and {v[1] for v in got.values()} == {"a" * 16}


def test_words_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "Abcdefg abcdefg ABCDEFG"), (3, "Abcdefg"), (None, "abcdefgh abcdefgh"),
            (None, "abcdefgh"), (4, "ÀÉÎÕÜßÿ àéîõüßÿ ÀÉÎÕÜßÿ"), (5, "abc" * 40000 + " " + "abc" * 40000),
            (6, "short Straße-weiter x×y÷zabc x×y÷zabc"), (7, "ABCDEF" * 3 + "日本")]
    df = spark.createDataFrame([(*r, "old") for r in rows], "doc_id long, text string, word string")
    for drop in (None, 3):
        got = {r.word: r.n for r in spelling.word_counts(df, drop_every=drop).collect()}
        assert got == brute_counts(rows, drop=drop)
    assert spelling.spelling_variants(spelling.word_counts(df.limit(0))).collect() == []


# token alignment

@pytest.fixture(scope="module")
def aligner():
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as f, \
            open(vocabulary("piece_bpe_32k.model"), "rb") as g:
        return token_alignment.Aligner(f.read(), g.read())


def brute_tokens(rows):
    """(ids a, ids b, bytes a, bytes b) of each text by the public libraries."""
    import sentencepiece
    import tokenizers

    from recprep.llm.bpe import byte_alphabet
    lib = tokenizers.Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    lib.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    alpha = byte_alphabet()
    for text in rows:
        if not text:
            yield [], [], [], []
            continue
        a, b = lib.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        left = [bytes(alpha[c] for c in lib.id_to_token(i)) for i in a]
        right = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
                 for p in map(sp.id_to_piece, b)]
        raw = (" " + text).encode()
        yield (a, b, left, right) if b"".join(left) == raw == b"".join(right) else ([], [], [], [])


def brute_alignment(texts):
    count, docs = Counter(), []
    for a, b, left, right in brute_tokens(texts):
        sa, sb = np.cumsum([0] + [len(x) for x in left]).tolist(), np.cumsum([0] + [len(x) for x in right]).tolist()
        links = []
        for i in range(len(a)):                       # byte by byte
            own = {j for j in range(max(0, np.searchsorted(sb, sa[i], "right") - 1), len(b)) if sb[j] < sa[i + 1]}
            links += [(a[i], b[j]) for j in sorted(own) if max(sa[i], sb[j]) < min(sa[i + 1], sb[j + 1])]
        cuts = sorted(set(sa) & set(sb))
        groups = [(a[sa.index(x):sa.index(y)], b[sb.index(x):sb.index(y)]) for x, y in zip(cuts, cuts[1:])]
        count.update(links)
        docs.append((a, b, groups, links))
    top = Counter()
    for (_, b), c in count.items():
        top[b] = max(top[b], c)
    out = []
    for a, b, groups, links in docs:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(count[k] == top[k[1]] for k in links),
                    sum(count[k] for k in links), hashlib.sha256(said.encode()).hexdigest() if a else ""))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_op13_equals_brute_force_on_whole_documents(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", 20_000)
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: w for r, w in zip(rows, brute_alignment([r.text for r in rows]))}
    out = queries.op13_token_alignment(spark, SF_SMALL)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in out.collect()}
    assert got == want and out.count() == len(rows)


def test_alignment_of_odd_texts(spark):
    rnd = random.Random(8)
    alphabet = "aeiou thnsr\n\t  .,'sdé日😀Ⅷ²½_-01<|endoftext|>▁<0x0A>  　"
    texts = [None, "", " ", "a", "a", "<s> </s> <|endoftext|>", "<0x0A>", "a▁b", "a\0b", "  two", "end ", "é" * 5000,
             "word " * 3000 + "end", "x" * 20000, "日本語" * 2000]
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 50))) for _ in range(150)]
    df = spark.createDataFrame([(i if i % 7 else None, t, "n", 1) for i, t in enumerate(texts)],
                               "doc_id long, text string, n_a string, block int")
    paths = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    out = token_alignment.link_counts(df, *paths)
    assert out.columns == ["doc_id", "text", "block", *COLUMNS[:6], "groups_sha256"]
    want = Counter((i if i % 7 else None, t, *w) for i, (t, w) in enumerate(zip(texts, brute_alignment(texts))))
    assert Counter((r.doc_id, r.text, *[r[c] for c in COLUMNS]) for r in out.collect()) == want
    assert token_alignment.link_counts(df.limit(0), *paths).collect() == []
    said = {r.text: ";".join(",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in r.groups)
            for r in token_alignment.align_texts(df, *paths).collect()}
    for t, w in zip(texts, brute_alignment(texts)):
        assert (hashlib.sha256(said[t].encode()).hexdigest() if said[t] else "") == w[6]


@pytest.mark.parametrize("window", [1, 2, 5, 1 << 16])
def test_align_is_window_independent(window):
    rnd = random.Random(window)
    for _ in range(400):
        n, p = rnd.randint(1, 80), rnd.random()
        a = [i for i in range(1, n) if rnd.random() < p] + [n]
        b = [i for i in range(1, n) if (i in a and rnd.random() < .8) or rnd.random() < .2] + [n]
        ga, gb, la, lb = token_alignment.align(np.array(a), np.array(b), window)
        sa, sb = [0] + a, [0] + b
        assert list(zip(la, lb)) == [(x, y) for x in range(len(a)) for y in range(len(b))
                                     if max(sa[x], sb[y]) < min(a[x], b[y])]
        assert [a[g - 1] for g in ga] == [b[g - 1] for g in gb] == sorted(set(a) & set(b))


def test_white_space_of_a_million_characters(aligner):
    text = "a" + " " * 1_200_000 + "b"
    (a, b), = aligner.tokens([text])
    assert b"".join(aligner.bytes_a[i] for i in a) == (" " + text).encode()
    assert b"".join(aligner.bytes_b[i] for i in b) == (" " + text).encode()


# toxicity

def test_features_are_distinct_and_whole():
    text = "Ab  c\nÉ" * 100
    assert np.array_equal(toxicity.features(text), toxicity.features("ab c é" * 100))
    for odd in (None, "", " \n "):
        assert len(toxicity.features(odd)) == 0
    rnd = random.Random(1)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(700_000))   # several parts
    squeezed = f" {re.sub(' +', ' ', long).strip()} "
    grams = {squeezed[i:i + n] for n in toxicity.SIZES for i in range(len(squeezed) - n + 1)}
    some = toxicity.features(long)
    spread = toxicity.DIMS * (1 - np.exp(-len(grams) / toxicity.DIMS))   # of as many random numbers
    assert 0.99 * spread < len(some) <= len(grams)
    use = np.zeros(toxicity.DIMS, dtype=bool)
    use[some[::3]] = True
    assert np.array_equal(toxicity.features(long, use), some[::3])


def brute_ratios(texts, labels):
    """r of every used feature by counting each text's features in a set."""
    have = [set(toxicity.features(t).tolist()) for t in texts]
    n = [labels.count(0), labels.count(1)]
    out = {}
    for f in set().union(*have):
        c = [sum(f in h for h, y in zip(have, labels) if y == k) for k in (0, 1)]
        p, share = sum(c) / sum(n), [c[k] / n[k] for k in (0, 1)]
        error = (p * (1 - p) * (1 / n[0] + 1 / n[1])) ** 0.5
        if abs(share[1] - share[0]) > toxicity.SIGNIFICANCE * error:
            some = toxicity.SMOOTHING / sum(n)
            r = float(np.log((share[1] + some) / (share[0] + some)))
            if abs(r) >= np.log(toxicity.LEAST_RATIO):
                out[f] = r
    return out


def labelled(n=400, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(2, 8))) for _ in range(30)]
        bad = rnd.random() < 0.3
        if bad:
            words[rnd.randint(0, 29)] = rnd.choice(["vexhag", "Quogbit"])
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_ratios_equal_brute_force_and_weights_fit(spark):
    rows = labelled(150)
    learn = spark.createDataFrame([(t, y) for _, t, y in rows], "text string, label int")
    got = {r.idx: r.r for r in toxicity._ratios(learn).collect()}
    assert got.pop(-1) == pytest.approx(sum(y for *_, y in rows) / len(rows))
    assert got == pytest.approx(brute_ratios([t for _, t, _ in rows], [y for *_, y in rows]))
    at, weight, intercept = toxicity.fit(learn)
    r = np.array([got[i] for i in at])
    # the gradient of mean log loss plus ridge is 0 at the fitted weights
    x = np.zeros((len(rows), len(at)))
    for k, (_, t, _) in enumerate(rows):
        x[k] = np.isin(at, toxicity.features(t)) * r
    w = np.divide(weight, r)
    p = 1 / (1 + np.exp(-(x @ w + intercept)))
    y = np.array([y for *_, y in rows])
    assert np.abs(x.T @ (p - y) / len(rows) + toxicity.RIDGE * w).max() < 1e-3
    assert abs((p - y).mean()) < 1e-3


def test_toxicity_on_odd_rows(spark):
    rows = labelled()
    extra = [(900, None), (901, ""), (902, " \n"), (None, "vexhag and more"), (903, "vexhag " * 200_000),
             (904, rows[0][1]), (904, rows[0][1])]
    docs = spark.createDataFrame([(i, t, 5, "k") for i, t, _ in rows] + [(i, t, 5, "k") for i, t in extra],
                                 "doc_id long, text string, score int, label string")
    marks = [(i, y) for i, _, y in rows] + [(None, 1), (3, None), (rows[5][0], rows[5][2]), (77777, 1), (12, 7)]
    labels = spark.createDataFrame(marks, "doc_id long, label int")
    out = toxicity.classify(docs, labels)
    assert out.columns == ["doc_id", "text", "label", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(rows) + len(extra)
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held) > 50
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[900].score == by[901].score == by[902].score
    assert by[903].predicted == 1 and by[904].score == by[rows[0][0]].score
    # held-out labels teach nothing
    flipped = spark.createDataFrame([(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y)
                                     for i, _, y in rows], "doc_id long, label int")
    again = {r.doc_id: r.score for r in toxicity.classify(docs, flipped).collect()}
    assert all(again[i] == pytest.approx(by[i].score, abs=1e-6) for i in truth)


@pytest.mark.parametrize("marks,score", [([], 0.5), ([(0, 1)], 0.999), ([(0, 0)], 0.001), ([(0, 0), (1, 1)], 0.5)])
def test_toxicity_without_much_to_learn(spark, marks, score):
    ids = [i for i in range(20) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame([(ids[0], "one text"), (ids[1], "another")], "doc_id long, text string")
    labels = spark.createDataFrame([(ids[k], y) for k, y in marks], "doc_id long, label int")
    assert [round(r.score, 6) for r in toxicity.classify(docs, labels).collect()] == [score, score]
    assert toxicity.classify(docs.limit(0), labels).collect() == []


def test_op12_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op12_toxicity(spark, sf)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = out.where("held_out").join(labels, "doc_id").agg(
        F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("right"),
        F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("wrong")).first()
    assert held.right >= 0.9 and held.wrong <= 0.02
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
