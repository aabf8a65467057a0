"""Encoding, token counts, packing, page text and languages, held against the
public libraries or brute force, with null, empty, long, repeated and clashing
rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from recprep.llm import bpe, html_text, language, packing, token_counts
from tests.llm.conftest import vocabulary

TEXTS = [None, "", "a", "  ", "Hello, world! it's  2 tabs\t\tend ", "x" * 3000, "日本語 <|endoftext|> ñ́ 😀 Ⅷ",
         "word " * 2000, "same", "same", "a\n\nb \n c", "'s't 'll"]


def frame(spark, texts=TEXTS, extra=True):
    rows = [(i, t, "n", 7) if extra else (i, t) for i, t in enumerate(texts)]
    # clashing names: the operators' result columns exist already
    cols = "doc_id long, text string" + (", ids string, n_tokens int" if extra else "")
    return spark.createDataFrame(rows, cols)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


def noise(n, alphabet, seed=1, most=60):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, most))) for _ in range(n)]


def test_encode_and_decode_equal_the_library(spark, library):
    texts = TEXTS + noise(200, "aeiou thnsr\n\t  .,'sdé日😀Ⅷ²½_-01<|endoftext|>")
    path = vocabulary("byte_bpe_50k.json")
    out = bpe.decode(bpe.encode(frame(spark, texts), path), path)
    assert out.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    for r in out.collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want
        assert r.decoded == library.decode(want, skip_special_tokens=False)
    both = bpe.encode(frame(spark, texts), path, decoded_col="decoded").collect()
    assert all(r.decoded == (r.text or "") for r in both)
    assert bpe.encode(frame(spark, []), path).collect() == []


def test_decode_nulls_and_broken_bytes(spark):
    df = spark.createDataFrame([(0, None), (1, []), (2, [162, 102])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(df, vocabulary("byte_bpe_50k.json")).collect()}
    assert got[0] == got[1] == ""
    assert "�" in got[2]


def brute_bpe(word, ranks):
    """Merge the lowest-ranked pair, leftmost first, until none is left."""
    parts = list(word)
    while True:
        best = min(((ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks), default=None)
        if best is None:
            return parts
        parts[best[1]:best[1] + 2] = ["".join(parts[best[1]:best[1] + 2])]


def test_automaton_gives_what_merging_gives():
    rnd = random.Random(5)
    for _ in range(60):
        vocab, merges = list("abc"), []
        for _ in range(12):
            a, b = rnd.choice(vocab), rnd.choice(vocab)
            if a + b not in vocab:
                vocab.append(a + b)
                merges.append((a, b))
        label = {v.encode(): i for i, v in enumerate(vocab)}
        auto = bpe.MergeAutomaton(label, [(a.encode(), b.encode()) for a, b in merges])
        enc = bpe.Encoder(auto)
        ranks = {m: i for i, m in enumerate(merges)}
        words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 14))) for _ in range(40)]
        for w, ids in zip(words, enc.words([w.encode() for w in words])):
            want = [vocab.index(p) for p in brute_bpe(w, ranks)]
            assert np.frombuffer(ids, "<u4").tolist() == want
            assert np.frombuffer(enc._long(w.encode()), "<u4").tolist() == want


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    def library(pieces, unknown):
        t = Tokenizer(models.Unigram(pieces, unknown, byte_fallback=True))
        t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
        return lambda s: len(t.encode(s, add_special_tokens=False).ids)

    pieces, unknown = token_counts.sentencepiece_vocabulary(vocabulary("piece_bpe_32k.model"))
    want = library(pieces, unknown)
    texts = TEXTS + noise(300, "aeiou thnsr\n\t  .,'é日😀Ⅷ▁<s><0x0A>")
    out = token_counts.count_tokens(frame(spark, texts), pieces, unknown)
    assert out.columns == ["doc_id", "text", "ids", "n_tokens", "best_score"]
    assert all(r.n_tokens == want(r.text or "") for r in out.collect())
    rnd = random.Random(2)
    for _ in range(100):                              # many ties
        names = {"".join(rnd.choice("abc▁") for _ in range(rnd.randint(1, 4))) for _ in range(12)}
        small = [("<unk>", 0.0)] + [(p, -float(rnd.randint(0, 3))) for p in sorted(names)]
        want, counter = library(small, 0), token_counts.Counter(small, 0)
        for s in noise(20, "abcd ", seed=rnd.randint(0, 9999), most=14):
            assert counter.text(s)[0] == want(s)


def test_packing_places_every_id_once(spark, library):
    out = packing.pack_documents(frame(spark), vocabulary("byte_bpe_50k.json"))
    pieces = out.toPandas()
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        mine = pieces[pieces.doc_id == i].sort_values("start")
        assert list(mine.start) == [0, *np.cumsum(mine.length)[:-1]] and mine.length.sum() == len(ids)
        for p in mine.itertuples():
            part = np.array(ids[p.start:p.start + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part) and p.doc_tokens == len(ids)
    for _, s in pieces.sort_values("offset").groupby("sequence_id"):
        assert list(s.offset) == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= 1024
    assert packing.pack_documents(frame(spark, []), vocabulary("byte_bpe_50k.json")).count() == 0


def test_packing_of_long_white_space(spark, library):
    texts = ["a" + " " * 2_000_000 + "b", "\n" * 2_000_000, "x" + " \t\u3000\n" * 500_000 + " y", "short  one"]
    pieces = packing.pack_documents(frame(spark, texts), vocabulary("byte_bpe_50k.json")).toPandas()
    for i, t in enumerate(texts):
        ids = library.encode(t, add_special_tokens=False).ids + [0]
        mine = pieces[pieces.doc_id == i].sort_values("start")
        assert mine.length.sum() == len(ids)
        for p in mine.itertuples():
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes())


def test_packing_keeps_all_three_limits(spark):
    rnd = random.Random(3)
    rows = [(i, list(range(n)), [int(rnd.random() < 0.5) for _ in range(n)])
            for i, n in enumerate(rnd.choice([0, 1, 5, 17, 30, 64]) for _ in range(400))]
    df = spark.createDataFrame(rows, "key int, ids array<int>, loss array<int>").repartition(2)
    limits = packing.Limits(tokens=64, segments=5, loss_tokens=30)
    with pytest.raises(Exception, match="may not be cut"):
        packing.pack_examples(df, ["key"], loss_col="loss", limits=limits).collect()
    got = packing.pack_examples(df, ["key"], loss_col="loss", limits=limits, cut=True).toPandas()
    by = got.groupby("sequence_id")
    assert by.length.sum().max() <= 64 and by.size().max() <= 5 and by.loss_tokens.sum().max() <= 30
    assert got.groupby("key").length.sum().to_dict() == {k: len(i) for k, i, _ in rows}
    whole = packing.pack_examples(df.where("size(ids) < 30"), ["key"], limits=limits).toPandas()
    assert (whole.start == 0).all() and whole.groupby("sequence_id").length.sum().max() <= 64


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script><style>p{}</style></head>
<body><header><a href="/">Site</a> <p>Slogan, of the, site</p></header><nav><ul><li><a>Menu</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, and more, and more, for reasons.</p></div>
<div id="main-col"><article class="post"><h1>Title &amp; more</h1><p>First <b>bo</b>ld
 paragraph, long enough, with commas.<p>Second &copy; one<br>here, also with, commas.
<ul class="related"><li><a href="x">Other</a></ul><div class="ad">Buy, buy, buy</div>
<form><p>Sign, up, now</p></form><p>Third &#233; <a href="y">link</a> in it.</p></article>
<aside><p>Side, bar, text, which is long enough to score.</p></aside>
<div id="comments"><p>I think, as a reader, that it is, well, long.</p></div></div>
<footer><p>Imprint, etc, etc</p></footer></body></html>"""


def test_html_keeps_the_article_and_nothing_else(spark):
    want = "Title & more First bold paragraph, long enough, with commas. Second © one here, also with, commas. " \
           "Third é link in it."
    df = spark.createDataFrame([(0, PAGE, "x"), (1, None, "x"), (2, "", "x"), (3, PAGE, "x"),
                                (4, "<nav>only a menu</nav>", "x"), (5, "<p>plain, text", "x"),
                                (6, "<div>" * 3000 + "deep, down" + "</div>" * 9, "x"), (7, "< <a '\"> <!-- ", "x")],
                               "page_id int, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert got[0] == got[3] == want
    assert got[1] == got[2] == got[4] == "" and got[5] == "plain, text" and got[6] == "deep, down"
    sections = ("<body><div><section><p>One, two, three, a paragraph.</p></section><section><p>Four, five, six, "
                "another one.</p></section></div><div class='sidebar'><p>no, no, no</p></div></body>")
    assert html_text.main_text(sections) == "One, two, three, a paragraph. Four, five, six, another one."


def test_html_wrappers_and_link_lists_stay():
    prose = "".join(f"<p>Paragraph {i}, which is long enough, and has commas, to be prose.</p>" for i in range(6))
    want = " ".join(f"Paragraph {i}, which is long enough, and has commas, to be prose." for i in range(6))
    side = "<div class='sidebar'><p>Side, bar, text, which is long enough to score.</p></div>"
    for attrs in ("class='content with-sidebar'", "class='no-sidebar'", "class='post share-enabled'",
                  "id='content-sidebar-wrap'"):
        for page in (f"<body><div {attrs}>{prose}</div></body>", f"<body><div {attrs}>{prose}{side}</div>{side}</body>",
                     f"<body><div class='site no-sidebar'><div {attrs}>{prose}</div>{side}</div></body>"):
            assert html_text.main_text(page) == want
    assert html_text.main_text(f"<body><form action='x'><div>{prose}</div><input><button>Go</button></form></body>") == want
    posts = f"<div class='post share-enabled'>{prose}</div>"
    assert html_text.main_text(f"<body><div>{posts}{posts}</div></body>") == f"{want} {want}"
    beside = f"<div id='sidebar-wrap'>{prose}</div><div id='comments'><p>I think, as a reader, that it is, well, long.</p></div>"
    assert html_text.main_text(f"<body>{beside}</body>") == want
    sources = "<ul><li><a href='a'>First source</a><li><a href='b'>Second source</a></ul>"
    article = "<body><article>{}{}<ul class='related'><li><a href='c'>Other</a></ul></article>{}</body>"
    comments = f"<div id='comments'>{prose.replace('Paragraph', 'I think') * 2}</div>"
    assert html_text.main_text(article.format(prose, sources, comments)) == f"{want} First source Second source"


def test_language_learns_and_rejects(spark):
    rnd = random.Random(4)
    syllables = {"aa": ["ba", "ko", "mi"], "bb": ["schu", "tzen", "ung"], "cc": ["ción", "ñan", "que"]}
    rows = [(i, " ".join("".join(rnd.choice(s) for _ in range(3)) for _ in range(30)), lang, "x")
            for i, (lang, s) in enumerate(list(syllables.items()) * 60)]
    n = len(rows)
    rows += [(n, None, "aa", "x"), (n + 1, "", "aa", "x"), (n + 2, "12 34 !", "bb", "x"), (None, rows[0][1], None, "x"),
             (n + 3, "русский текст из других букв " * 4, None, "x"), rows[1], rows[1]]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string, score string")
    got = language.identify(df)
    assert got.columns == ["doc_id", "text", "lang", "held_out", "lang_pred", "score", "rejected"]
    got = got.toPandas()
    known = got[(got.doc_id < n) & got.lang.notna()]
    assert (known.lang == known.lang_pred).all() and not known.rejected.any()
    assert got.score.between(0, 1).all() and len(got) == len(rows)
    crc = known.doc_id.astype(int).astype(str).map(lambda s: zlib.crc32(s.encode()) % 5 == 0)
    assert (crc == known.held_out).all() and known.held_out.any()
    odd = got.set_index("doc_id")
    for i in (n, n + 1, n + 2):
        assert odd.lang_pred[i] == "und" and odd.rejected[i] and odd.score[i] == 0
    assert odd.rejected[n + 3] and odd.lang_pred[n + 3] in syllables
    empty = language.identify(df.where(F.lit(False)))
    assert empty.count() == 0
    none = language.identify(df.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").distinct()
    assert [r[0] for r in none.collect()] == ["und"]
