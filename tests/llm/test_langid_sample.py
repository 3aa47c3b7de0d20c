import zlib

import numpy as np
import pytest

from agoralens.llm import langid
from agoralens.llm.common import LETTER


def test_rare_language_is_learned_and_idf_covers_all_rows(docs_of):
    rows = [(i, f"the cat number {'abcdefg'[i % 7]} sits", "en") for i in range(400)]
    rows += [(i, f"żółw łódź {'abcdefg'[i % 7]} pięść", "pl") for i in range(1000, 1012)]
    docs = docs_of(rows)
    model = langid.train(docs, sample=5)
    assert model.languages == ["en", "pl"]
    assert model.predict("żółw łódź pięść")[0] == "pl"
    learned = docs.where(~langid.held_out("doc_id", 4)).collect()
    seen = np.zeros(1 << langid.BUCKET_BITS)
    for r in learned:
        assert LETTER.search(r["text"])
        seen[langid.counts_of(r["text"])[0]] += 1
    assert np.allclose(model.idf, np.log((1 + len(learned)) / (1 + seen)) + 1)


def test_languages_that_were_not_learned_are_uncertain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    assert 0.25 < model.least < 1
    for text in (
        "Det var en gång en liten flicka som bodde i en stuga vid skogen och hon hade en röd mössa på huvudet",
        "Dawno temu żyła sobie mała dziewczynka która mieszkała w chatce przy lesie i nosiła czerwony kapturek",
        "Жила была маленькая девочка в домике у леса и носила она красную шапочку на голове",
        "xqz wvk jjp zzq kxw vvq pzx wqj kkz xxv",
    ):
        assert not model.told(text)[2], (text, langid.soft_max(model.logits(*langid.counts_of(text))), model.least)
    told = [r for r in langid.with_language(docs, model, certain_name="sure").collect() if r["lang_pred"] != "und"]
    assert np.mean([r["sure"] for r in told]) > 0.995


def test_repeated_ids_take_one_place(docs_of):
    rows = [(7, "the same words", "en")] * 50 + [(8, "die selben worte", "de"), (9, "12", "de"), (10, None, "de")]
    found = langid.labelled_sample(docs_of(rows), 4, 1000, "doc_id", "text", "lang").collect()
    held = {i for i in (7, 8, 9, 10) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sorted(r["text"] for r in found) == sorted(t for i, t in ((7, "the same words"), (8, "die selben worte")) if i not in held)


def test_scores_equal_a_plain_fit(docs_of):
    """The whole training again in plain Python: sample, frequencies, leader on each shard, temperature."""
    rng = np.random.default_rng(0)
    words = {"en": ["the", "cat", "house", "with"], "de": ["der", "hund", "haus", "mit"], "fr": ["le", "chat", "maison", "avec"]}
    rows = [(i, " ".join(rng.choice(words[lang], 4)), lang) for i, lang in enumerate(np.array(["en", "de", "fr"])[rng.integers(0, 3, 60)])]
    rows = [(i, t, str(lang)) for i, t, lang in rows]
    docs = docs_of(rows)
    model = langid.train(docs)
    learned = {r["doc_id"]: r["part"] for r in docs.where(~langid.held_out("doc_id", 4)).selectExpr("doc_id", "cast(pmod(xxhash64(doc_id, 3), 24) AS int) AS part").collect()}
    size = 1 << langid.BUCKET_BITS
    seen = np.zeros(size)
    for i, t, _ in rows:
        if i in learned:
            seen[langid.counts_of(t)[0]] += 1
    idf = np.log((1 + len(learned)) / (1 + seen)) + 1
    total, weights = 0, np.zeros((size, 3))
    for shard in range(langid.SHARDS):
        mine = []
        for i, t, lang in rows:
            if learned.get(i, 0) >= langid.SHARDS and learned[i] % langid.SHARDS == shard:
                f, n = langid.counts_of(t)
                mine.append((["de", "en", "fr"].index(lang), f, langid.tf_idf(f, n, idf)))
        mine.sort(key=lambda r: (r[0], len(r[1]), r[1].astype(np.int32).tobytes(), r[2].tobytes()))
        z, squares, order = np.zeros((size, 3)), np.zeros((size, 3)), np.random.default_rng(11)
        for _ in range(langid.EPOCHS):
            for at in order.permutation(len(mine)):
                y, f, x = mine[at]
                rate = (langid.BETA + np.sqrt(squares[f])) / langid.ALPHA + langid.L2
                w = np.where(np.abs(z[f]) <= langid.L1, 0, -(z[f] - np.sign(z[f]) * langid.L1) / rate)
                p = np.exp(x @ w - (x @ w).max())
                p /= p.sum()
                p[y] -= 1
                g = np.outer(x, p)
                z[f] += g - (np.sqrt(squares[f] + g * g) - np.sqrt(squares[f])) / langid.ALPHA * w
                squares[f] += g * g
        rate = (langid.BETA + np.sqrt(squares)) / langid.ALPHA + langid.L2
        weights += len(mine) * np.where(np.abs(z) <= langid.L1, 0, -(z - np.sign(z) * langid.L1) / rate)
        total += len(mine)
    weights /= total
    for r in langid.with_language(docs, model).collect():
        f, n = langid.counts_of(r["text"])
        logits = langid.tf_idf(f, n, idf) @ weights[f] / model.temperature
        p = np.exp(logits - logits.max())
        p /= p.sum()
        assert r["score"] == pytest.approx(p.max(), abs=1e-4) and r["lang_pred"] == ["de", "en", "fr"][int(p.argmax())]
