"""Long attributes, repeated and nested sections of pages; memory and padding
of packing."""

import random
import time
import zlib

import numpy as np
import pytest

from recprep.llm import html_text, packing
from tests.llm.conftest import vocabulary


def words(i, n=8):
    rnd = random.Random(i)
    return f"Part {i}, " + ", ".join("".join(rnd.choice("aeilnorst") for _ in range(6)) for _ in range(n)) + "."


@pytest.mark.parametrize("size", [1000, 70_000, 1_000_000])
@pytest.mark.parametrize("quote", ["'", '"'])
def test_attribute_values_of_any_length(size, quote):
    other = "'" if quote == '"' else '"'
    value = ("x > y <p>" + other) * (size // 10)
    page = f"<body><div data-x={quote}{value}{quote} id=z><p>{words(1)}</p><p>{words(2)}</p></div></body>"
    assert html_text.main_text(page) == f"{words(1)} {words(2)}"


def test_tags_take_linear_time():
    for odd in ("<a title=\"x> ", "<a b='x> ", "<a x=   ", "< <a '\"> "):
        start = time.process_time()
        html_text.main_text(f"<p>{words(1)}</p>" + odd * 40_000)
        assert time.process_time() - start < 20


def test_an_unclosed_quote_ends_its_tag():
    assert html_text.main_text(f"<p>{words(1)}</p><p class=\"x>{words(2)}</p><p>{words(3)}") == " ".join(map(words, (1, 2, 3)))


def brute_best_branches(parts, wrap):
    """Pages of equal or like sections hold all their text."""
    return "<body><div id='top'>" + "".join(wrap.format(p) for p in parts) + "</div></body>"


@pytest.mark.parametrize("wrap", [
    "<div><div><p>{}</p></div></div>", "<section><div><div><p>{}</p></div></div></section>",
    "<article><p>{}</p></article>", "<article><div><p>{}</p></div></article>",
    "<div><section><blockquote><p>{}</p></blockquote></section></div>", "<p>{}</p>"])
@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_nested_and_repeated_sections_stay(wrap, n):
    parts = [words(i) for i in range(n)]
    assert html_text.main_text(brute_best_branches(parts, wrap)) == " ".join(parts)


def test_equal_articles_and_short_ends_stay():
    article = f"<article><h1>Head</h1><p>{words(1)}</p><p>{words(2)}</p></article>"
    one = f"Head {words(1)} {words(2)}"
    assert html_text.main_text(f"<body>{article}{article}</body>") == f"{one} {one}"
    menu = "<div><a href='a'>One menu entry</a> <a href='b'>another menu entry</a></div>"
    assert html_text.main_text(f"<body>{menu}{article}{article}{menu}</body>") == f"{one} {one}"
    body = f"<div><p>{words(1)}</p><p>{words(2)}</p><p>{words(3)}</p></div><div><p>Bye, now.</p></div>"
    assert html_text.main_text(f"<body><main>{body}</main></body>").endswith("Bye, now.")
    ads = "<div class='ad'><p>Buy, buy, buy, buy, buy, and buy again, all of you.</p></div>"
    pair = f"<div><div><p>{words(4)}</p></div></div>"
    assert html_text.main_text(f"<body><div>{pair}{ads}{pair}</div><nav><p>{words(9)}</p></nav></body>") == \
        f"{words(4)} {words(4)}"


def test_a_lone_article_is_all():
    page = f"<body><div><article><p>{words(1)}</p><p>{words(2)}</p></article><div><p>{words(3)}</p></div></div></body>"
    assert html_text.main_text(page) == f"{words(1)} {words(2)}"


def brute_main(sections):
    """What a page of one container per section keeps: those that score half
    of the best at least, by the rule written out."""
    def points(s):
        return min(len(s) / 100, 3.0) + s.count(",") + (1.0 if len(s) >= 25 else 0.1)
    score = [sum(points(p) for p in ps) + 5.0 for ps in sections]
    top = max(score)
    return top, [s >= 0.5 * top or s >= max(10.0, 0.2 * top) for s in score]


def test_like_sections_by_brute_force():
    rnd = random.Random(6)
    for _ in range(150):
        sections = [[words(rnd.randint(0, 999), rnd.randint(1, 9)) for _ in range(rnd.randint(1, 4))]
                    for _ in range(rnd.randint(2, 5))]
        _, like = brute_main(sections)
        # two levels down, so that no section is a sibling of the best
        page = "<body>" + "".join("<section><div>" + "".join(f"<p>{p}</p>" for p in ps) + "</div></section>"
                                  for ps in sections) + "</body>"
        got = html_text.main_text(page)
        for ps, keep in zip(sections, like):
            if keep or sum(like) > 1:                 # the body is raised to: all prose stays
                assert " ".join(ps) in got
            else:
                assert not keep


def deep_size(packer):
    total = 0
    for w in packer.waiting:
        if w is not None:
            (_, ids, flags, *_), _, running, _ = w
            total += ids.nbytes + (0 if flags is None else flags.nbytes) + (0 if running is None else running.nbytes)
            assert ids.base is None and (running is None or running.base is None)
    return total


@pytest.mark.parametrize("masked", [False, True])
def test_window_holds_what_waits_and_no_more(masked, monkeypatch):
    """1,024 examples of a million tokens: the window stays under 32 MB."""
    held, wait = [], packing.Packer._wait

    def watched(self, *args):
        wait(self, *args)
        held.append(self)
    monkeypatch.setattr(packing.Packer, "_wait", watched)
    placed = np.zeros(1024, dtype=np.int64)

    def emit(key, start, length, sequence, offset):
        placed[key[0]] += length

    def trim(key, start, length):
        k, ids, flags, base, total = key
        span = slice(start - base, start - base + length)
        return k, ids[span].copy(), None if flags is None else flags[span].copy(), start, total

    packer = packing.Packer(packing.Limits(segments=1024), emit, trim=trim)
    n = 1_000_000
    ids = np.zeros(n, dtype="<u4")
    for i in range(1024):
        flags = np.ones(n, dtype=np.int64) if masked else None
        running = np.arange(n + 1) if masked else None
        packer.add((i, ids, flags, 0, n), n, running)
    assert deep_size(packer) < 32 << 20 and held
    packer.flush()
    assert (placed == n).all()


def test_tiny_texts_fill_their_sequences(spark):
    rows = [(i, "a" if i % 3 else "a b") for i in range(20_000)] + [(99_999, "word " * 5000), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = packing.pack_documents(df, vocabulary("byte_bpe_50k.json")).toPandas()
    used = got.groupby("sequence_id").length.sum()
    assert used.max() <= 1024 and used.sum() / (1024 * len(used)) > 0.95
    assert got.groupby("sequence_id").size().max() > 256
    assert (got.groupby("doc_id").length.sum() == got.groupby("doc_id").doc_tokens.first()).all()


def test_pieces_of_long_masked_examples_are_right(spark):
    rnd = random.Random(9)
    rows = [(i, [rnd.randint(0, 9) for _ in range(n)], [int(rnd.random() < 0.6) for _ in range(n)])
            for i, n in enumerate([0, 1, 300, 64, 65, 1000, 7, 64, 500])]
    df = spark.createDataFrame(rows, "key int, ids array<int>, loss array<int>").coalesce(1)
    limits = packing.Limits(tokens=64, segments=3, loss_tokens=20)
    got = packing.pack_examples(df, ["key"], loss_col="loss", limits=limits, cut=True).toPandas()
    for i, ids, loss in rows:
        at = 0
        for p in got[got.key == i].sort_values("start").itertuples():
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            assert p.loss_tokens == sum(loss[at:at + p.length])
            at += p.length
        assert at == len(ids)
    assert got.groupby("sequence_id").loss_tokens.sum().max() <= 20


def test_space_poor_text_is_not_remembered():
    import json
    import random

    import public_tokenizers
    import tokenizers

    from recprep.llm import bpe

    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        encoder = bpe.Encoder(bpe.load_automaton(f.read()))
    lib = tokenizers.Tokenizer.from_file(path)
    lib.no_truncation(), lib.no_padding()
    rnd = random.Random(4)
    alphabet = "ABCDEFGHIJKLMNOPabcdefghijklmnop0123456789+/"
    texts = ["".join(rnd.choice(alphabet) for _ in range(3000)) + " short words " + "汉字" * 300 + ". " + "x" * 200 + ","
             for _ in range(40)]
    got = encoder(texts)
    assert [list(memoryview(g).cast("I")) for g in got] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert max(map(len, encoder.chunks), default=0) <= bpe.LONGEST_CHUNK
    assert encoder.held < 40 * 2000
    old, bpe.MEMO_BYTES = bpe.MEMO_BYTES, 1000
    try:
        for i in range(50):
            words = " ".join(f"w{i}q{j}z" for j in range(20))
            assert list(memoryview(encoder([words])[0]).cast("I")) == lib.encode(words, add_special_tokens=False).ids
        assert len(encoder.chunks) <= 60
    finally:
        bpe.MEMO_BYTES = old
