import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from agoralens.llm import html_text, packing, sharding
from agoralens.llm.html_examples import labelled_pages
from agoralens.llm.sentencepiece_codec import MARK, Codec, round_trip, with_ids, with_parity, with_text

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "a  b", " a", "a ", "a\nb", "a \nb", "a\n b", "a\t b", "a　 b", "don't 's it's", "a   b", "日本 語😀 é",
    "\n", "\n\na b\n\n", "a▁b ▁ c", "<s> x</s>", "<unk>", "<0x41>", "a<|endoftext|> b", "12 34.5 a--b, c.", "x y z", "A." * 3000,
]


def odd_texts(seed, alphabet, n=1500):
    rng = random.Random(seed)
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(n)]


# --- packing ------------------------------------------------------------------------------


def test_word_tokenizer_gives_the_ids_of_the_tokenizer(documents):
    texts = odd_texts(0, "ab \n\t'1.é　, ") + [r["text"] for r in documents.collect()]
    plain = Tokenizer.from_file(BPE).encode_batch(texts, add_special_tokens=False)
    assert packing.WordTokenizer(BPE).encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in plain]


def test_word_tokenizer_merges_a_word_once(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    tokenizer, merged = packing.WordTokenizer(BPE), []
    merge = tokenizer.merge
    monkeypatch.setattr(tokenizer, "merge", lambda part: merged.append(part) or merge(part))
    texts = ["To harbour, harbour. harbour!! (harbour) harbour", "", "of\nharbour; harbour été,", "été", "a  été", "9"]
    texts += [f"to harbour word{i} other" for i in range(8)]  # more words than are kept
    plain = tokenizer.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert tokenizer.encode(texts[:6]) + [x for t in texts[6:] for x in tokenizer.encode([t])] == [
        np.array(e.ids, "<u4").tobytes() for e in plain
    ]
    assert sum("harbour" in part and part[0] == packing.SPACE_NAME for part in merged) == 1


def fewest_bins(lengths, capacity):
    """By trying all partitions of a few items."""
    best = [len(lengths)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + lengths[i] <= capacity:
                go(i + 1, [*bins[:b], bins[b] + lengths[i], *bins[b + 1 :]])
        go(i + 1, [*bins, lengths[i]])

    go(0, [])
    return best[0]


def test_lower_bound_is_never_above_the_optimum():
    rng = np.random.default_rng(0)
    tight = 0
    for _ in range(120):
        lengths = rng.integers(1, 33, rng.integers(1, 9))
        best, bound = fewest_bins(lengths.tolist(), 32), packing.lower_bound(lengths, 32)
        assert -(-lengths.sum() // 32) <= bound <= best
        tight += bound == best
    assert tight > 100


def test_best_fit_fills_bins_without_overlap():
    lengths = np.random.default_rng(1).integers(1, 1024, 3000)
    bins, offsets = packing.best_fit(lengths)
    order = np.lexsort((offsets, bins))
    ends = (offsets + lengths)[order]
    starts_bin = np.append(True, np.diff(bins[order]) > 0)
    assert (offsets[order][starts_bin] == 0).all() and ends.max() <= 1024
    assert (offsets[order][1:][~starts_bin[1:]] == ends[:-1][~starts_bin[1:]]).all()
    assert bins.max() + 1 <= packing.lower_bound(lengths) * 1.01


def checked(rows, docs, capacity=1024):
    """Every piece is right and lies without gaps; the number of sequences."""
    tokenizer, want = Tokenizer.from_file(BPE), []
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        cut = (len(ids) - 1) % capacity + 1
        edges = [0, *range(cut, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            want.append((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted((tuple(r[n] for n in names) for r in rows), key=str) == sorted(want, key=str)
    sequences = {}
    for r in sorted(rows, key=lambda r: r["offset"]):
        assert r["offset"] == sequences.get(r["sequence_id"], 0)
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(sequences.values(), default=0) <= capacity
    return len(sequences)


def test_pack_odd_rows(docs_of):
    docs = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x"), (4, "long text, " * 3000), (5, "w " * 1023), (6, "w " * 1022 + "w")]
    checked(packing.pack(docs_of(docs), BPE).collect(), docs)
    assert packing.pack(docs_of([]), BPE).count() == 0


def test_pack_in_many_parts_comes_near_the_bound(documents):
    docs = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    rows = packing.pack(documents, BPE, part_rows=30).collect()
    count = checked(rows, docs)
    assert count <= packing.lower_bound([r["length"] for r in rows]) * 1.03
    packed = documents.sparkSession.createDataFrame(rows)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(documents, packed, BPE).collect()}
    ids = {d: [*Tokenizer.from_file(BPE).encode(t, add_special_tokens=False).ids, 2] for d, t in docs[:20]}
    for r in rows:
        if r["doc_id"] in ids:
            piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
            assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == piece


# --- SentencePiece ------------------------------------------------------------------------


def as_ids(rows):
    return [np.frombuffer(r, "<u4").tolist() for r in rows]


def test_codec_matches_the_library(documents):
    texts = odd_texts(3, "ab \n\t'1.é　▁日😀") + [" " * k + "x" + " " * j for k in range(20) for j in range(20)]
    texts += [r["text"] for r in documents.collect()]
    codec, library = Codec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    coded = codec.encode(texts)
    assert as_ids(coded) == library.encode(texts)
    assert codec.decode(coded) == library.decode(library.encode(texts)) == [t.replace(MARK, " ") for t in texts]


def message(*fields):
    """A protobuf message from (number, value) pairs."""
    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += bytes([number << 3 | 5]) + struct.pack("<f", value)
            continue
        body = value if isinstance(value, bytes) else None
        n = len(body) if body is not None else value
        out += varint(number << 3 | (2 if body is not None else 0)) + varint(n) + (body or b"")
    return out


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """A hand-made unigram model with byte fallback; its scores are written, not trained."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    words = ["▁", "a", "b", "c", "ab", "▁a", "▁ab", "bc", "abc", "▁abc", "ca", "▁b", "cab"]
    pieces += [(w, -1.0 - 0.37 * i / len(w), 1) for i, w in enumerate(words)]
    body = [(1, message((1, p.encode()), (2, s), (3, k))) for p, s, k in pieces]
    trainer = message((3, 1), (35, 1), (40, 0), (41, 1), (42, 2))
    spec = message((1, b"identity"), (2, b""), (3, 1), (4, 1), (5, 1))
    path = tmp_path_factory.mktemp("sp") / "unigram.model"
    path.write_bytes(message(*body, (2, trainer), (3, spec)))
    return str(path)


def test_unigram_scores_and_byte_fallback(unigram):
    library = sentencepiece.SentencePieceProcessor(model_file=unigram)
    codec = Codec(unigram)
    texts = [t for t in odd_texts(5, "abc é", 800) if "<" not in t]
    assert as_ids(codec.encode(texts)) == library.encode(texts)
    assert codec.decode(codec.encode(texts)) == library.decode(library.encode(texts))


def test_codec_columns(docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "Hello  world é"), (3, "Hello  world é"), (4, "word " * 40000)])
    coded = with_text(with_ids(docs, PIECES), PIECES).collect()
    assert [r["decoded"] for r in coded] == ["", "", "Hello  world é", "Hello  world é", "word " * 40000]
    assert all(r["parity"] for r in with_parity(docs, PIECES).collect())
    whole = round_trip(docs, PIECES)
    assert whole.columns.count("ids") == 1 and [r["ids"] for r in whole.collect()] == [r["ids"] for r in coded]
    assert with_ids(docs_of([]), PIECES).count() == 0


# --- pages --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark):
    return html_text.default_model(spark)


ARTICLE = "<h1>A title of some words</h1><p>First &amp; best   words,\n&nbsp;all of <b>them</b>.<br>Next.<p>Second &#233; text; it is here.</p>"
WANT = "A title of some words\nFirst & best words, all of them. Next.\nSecond é text; it is here."
NOISE = "This is some other long text, with a stop. It is not what people came to read on this page at all."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>t</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><a href='/'>Home</a></nav><article>{ARTICLE}</article><footer>{NOISE}</footer>",
        f"<body><header><p>{NOISE}</p></header><main>{ARTICLE}</main><aside><p>{NOISE}</p></aside></body>",
        f"<div id='sidebar'><p>{NOISE}</p></div><article>{ARTICLE}<div class='ads'><p>{NOISE}</p></div></article><section class='comments'><p>{NOISE}</p><p>{NOISE}</p></section>",
        f"<body><div class='cookie-banner'>{NOISE}</div><div class='entry-content'>{ARTICLE}</div><form><p>{NOISE}</p><select><option>x</option></select></form><!-- {NOISE} --></body>",
        f"<article>{ARTICLE}</article><div id='reader-comments'><div><p>{NOISE}</p></div></div><div class='notice'>{NOISE}</div>",
        f"<ul class=menu><li><a href=a>One</a><li><a href=b>Two</a></ul><article class='post'>{ARTICLE}</article><template><p>{NOISE}</p></template><noscript>{NOISE}</noscript>",
    ],
)
def test_main_text(model, page):
    assert model.text(page) == WANT


def test_marginals_are_those_of_all_labellings(model):
    page = html_text.read_page("<div><p>Some words here.</p><nav><a>x</a></nav></div><p>More.</p>")
    n = len(page.parent)
    total, hit = 0.0, np.zeros(n)
    for labels in np.ndindex(*[2] * (n - 1)):
        y, p = (0, *labels), 1.0
        for i in range(1, n):
            chance = model.step(page.place(i))[y[page.parent[i]]]
            p *= (chance if y[i] else 1 - chance) * np.exp(y[i] * sum(model.facts.get(f, 0.0) for f in page.evidence(i)))
        total, hit = total + p, hit + p * np.array(y)
    assert model.marginals(page) == pytest.approx((hit / total).tolist())


def test_the_model_learns_its_labelled_pages(model):
    wrong = seen = 0
    for html in labelled_pages(html_text.NAMES):
        page = html_text.read_page(html)
        for i, share in enumerate(model.marginals(page)):
            seen += page.length[i] > 0
            wrong += page.length[i] > 0 and (share >= 0.5) != bool(page.label[i])
    assert wrong <= 0.02 * seen


def test_odd_pages(spark, model):
    rows = [(1, None, "n"), (2, "", "n"), (3, "<p>", "n"), (4, "<div>" * 5000 + "deep", "n"), (5, f"<article>{ARTICLE}</article>" + "<p>x</p>" * 20000, "n"), (None, "plain", "n"), (2, "", "n")]
    pages = spark.createDataFrame(rows, "page_id int, html string, text string")
    out = html_text.with_main_text(pages, model)
    got = out.collect()
    assert out.columns == ["page_id", "html", "text", "n_chars"] and len(got) == 7
    assert all(r["n_chars"] == len(r["text"]) for r in got) and got[0]["text"] == got[1]["text"] == ""
    assert html_text.with_main_text(pages.limit(0), model).count() == 0


# --- shards -------------------------------------------------------------------------------


def test_every_shard_gets_its_share_and_most_slots_stay():
    names = [f"s{i}" for i in range(30)]
    table = sharding.lookup_table(names, 1009)
    counts = np.bincount(table, minlength=30)
    assert counts.min() >= 1009 // 30 and counts.max() <= 1009 // 30 + 1
    fewer = sharding.lookup_table(names[:7] + names[8:], 1009)
    left = [names.index(n) for n in names[:7] + names[8:]]
    moved = sum(a != 7 and a != left[b] for a, b in zip(table, fewer))
    assert moved < 0.25 * 1009


def test_lookup_table_takes_turns_by_preference():
    names, slots = ["x", "y", "z"], 13
    claimed = {}
    prefer = {}
    for n in names:
        start, step = sharding._number(f"start {n}") % slots, sharding._number(f"step {n}") % (slots - 1) + 1
        prefer[n] = [(start + i * step) % slots for i in range(slots)]
        assert sorted(prefer[n]) == list(range(slots))
    while len(claimed) < slots:
        for n in names:
            free = [s for s in prefer[n] if s not in claimed]
            if free:
                claimed[free[0]] = n
    assert [names[i] for i in sharding.lookup_table(names, slots)] == [claimed[s] for s in range(slots)]
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 12)
    with pytest.raises(ValueError):
        sharding.lookup_table(["x", "x"])


def test_place_and_write(spark, tmp_path):
    df = spark.createDataFrame([(i % 50, "old") for i in range(100)] + [(None, "old")], "k bigint, slot string")
    placed = sharding.place(df, "k", ["a", "b", "c"], 101)
    assert placed.columns == ["k", "slot", "shard"] and placed.select("k", "shard").distinct().count() == 51
    sharding.write_shards(df, "k", ["a", "b", "c"], str(tmp_path / "out"), 101, files_per_shard=2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 101
    plan = placed._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_gathered_bytes_decode_as_the_library_does():
    codec = Codec(PIECES)
    rng = np.random.default_rng(4)
    size = len(codec.model.pieces)
    byte_ids = [i for i, k in enumerate(codec.model.kinds) if k == 6]
    lists = [rng.integers(0, size, rng.integers(0, 60)) for _ in range(200)]
    lists += [rng.choice(byte_ids, rng.integers(1, 9)) for _ in range(100)]  # mostly no valid text
    lists += [np.append(rng.integers(0, size, 3), rng.choice(byte_ids, 2)) for _ in range(50)] + [np.arange(size)]
    coded = [ids.astype("<u4").tobytes() for ids in lists]
    assert codec.decode(coded) == codec.decode_by_library(coded)
    assert codec.decode([]) == [] and codec.decode([b"", b""]) == ["", ""]


def test_a_full_cache_starts_anew(monkeypatch):
    from agoralens.llm import sentencepiece_codec

    monkeypatch.setattr(sentencepiece_codec, "CACHED_WORDS", 3)
    codec = Codec(PIECES)
    texts = ["some words of a text", "some other words", "", "words words  words"]
    first = codec.encode(texts)
    assert len(codec.cache) > 3 and codec.encode(texts) == first and codec.decode(first) == texts


SENTENCES = "This is a sentence of the article, and it goes on for a while so that it is long. " * 3
BODY = f"<p>{SENTENCES}</p>" * 4
LINES = "\n".join([SENTENCES.strip()] * 4)


@pytest.fixture(scope="module")
def tree(spark):
    return html_text.default_model(spark)


@pytest.mark.parametrize(
    "html, text",
    [
        (f'<body><nav>a</nav><article class="post related-topic">{BODY}</article><footer>x</footer></body>', LINES),
        (f'<body><article class="post comments-open">{BODY}</article></body>', LINES),
        (f'<body><div class="content has-sidebar">{BODY}</div></body>', LINES),
        (f'<body><article><h1 class="entry-header">A title</h1>{BODY}</article></body>', f"A title\n{LINES}"),
        (f'<body><article>{BODY}<p class="read-more-text">{SENTENCES}</p></article></body>', f"{LINES}\n{SENTENCES.strip()}"),
        (BODY, LINES),
        (f"<html><head><title>t</title></head>{BODY}</html>", LINES),
        (SENTENCES * 3, (SENTENCES * 3).strip()),
        (f"<body><article><svg/>{BODY}</article></body>", LINES),
        (f'<body><article><svg><path d="x"/><g><text>no</text></g></svg>{BODY}</article></body>', LINES),
        (f"<body><article><math><mi>x</mi><mspace/></math>{BODY}</article></body>", LINES),
        (f'<body><div class="post-content"><noscript><div>x</div></noscript>{BODY}</div></body>', LINES),
        (f"<body><article><select><option>a<option>b</select><noscript><p>x<p>y</noscript>{BODY}</article></body>", LINES),
        (f'<body><article>{BODY}</article><section class="comments"><article class="comment">{BODY}</article></section></body>', LINES),
        (f'<body><article>{BODY}</article><div class="sidebar">{BODY}</div><p class="advert">{SENTENCES}</p></body>', LINES),
    ],
)
def test_odd_markup_and_names(tree, html, text):
    assert tree.text(html) == text
