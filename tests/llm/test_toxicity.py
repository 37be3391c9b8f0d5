from __future__ import annotations

import zlib

import pyarrow as pa
import pytest

from rollcall.llm import toxicity
from rollcall.llm.common import read, text_buffers
from tests.llm.conftest import HARD

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.character_model(read(spark, DATA, "documents"))


def restored(texts, model):
    data, starts = text_buffers(pa.array(texts, pa.string()))
    data, starts = toxicity.restored(data, starts, toxicity.Decoder(model))
    return [" ".join(data[a:b].tobytes().decode().split())
            for a, b in zip(starts[:-1], starts[1:], strict=True)]


@pytest.mark.parametrize("disguised, word", [
    ("1d10t", "idiot"), ("i d i o t", "idiot"), ("I.D.I.O.T", "idiot"), ("iiidiooot", "idiot"),
    ("id-iot", "idiot"), ("stuupid", "stupid"), ("m0r0n", "moron"), ("$tup1d", "stupid"),
    ("l0ser", "loser"), ("tr@sh", "trash"), ("p4th3t1c", "pathetic"), ("d!sgust!ng", "disgusting"),
    ("S c u m", "scum"), ("looooser", "loser"), ("(cl0wn)", "clown"), ("MORON!!", "moron"),
])
def test_disguises_are_read(model, disguised, word):
    assert restored([disguised, f"and the {disguised}, of"], model) == [word, f"and the {word} of"]


def test_plain_text_is_its_own_restoration(model):
    texts = ["The and of", "Über, naïve façade. Ist", "“quoted” word—word", "", None, "12 34 ... !!",
             "日本語 b"]
    want = ["the and of", "Über naïve façade ist", "quoted word word", "", "", "", "日本語 b"]
    assert restored(texts, model) == want


def test_decoding_finds_the_cheapest_reading(model):
    """Viterbi against every path of the lattice."""
    cost = -model.astype(float)
    decoder = toxicity.Decoder(model)

    def price(symbols):
        a = b = 0
        total = 0.0
        for s in [*symbols, 0]:
            if s or b:
                total += cost[a, b, s]
                a, b = (b, s) if s else (0, 0)
        return total

    for stretch in (b"1d1", b"a.b", b"ss0", b"i d t", b"5eell", b"a-1b", b"x", b"4!"):
        paths = [(0.0, b"", ())]
        for unit in toxicity._lattice(stretch):
            paths = [(c + k, t + u, s + v) for c, t, s in paths for k, u, v in unit]
        best = min(c + price(s) for c, _, s in paths)
        texts = {b" ".join(t.split()) for c, t, s in paths if c + price(s) <= best + 1e-6}
        assert decoder.restore(stretch) in texts


def test_trigrams_are_counted_within_words():
    data, starts = text_buffers(pa.array(["Ab c", None, "ab\n\nab", "é"]))
    counts = toxicity.trigram_counts(data, starts).reshape((59,) * 3)
    assert counts[0, 0, 1] == 3 and counts[0, 1, 2] == 3 and counts[1, 2, 0] == 3
    assert counts[0, 0, 3] == 1 and counts[0, 3, 0] == 1
    assert counts.sum() == 3 * 3 + 2 + 3  # the last text is two bytes and an end


def test_held_out_labels_are_found_and_clean_documents_left_alone(spark):
    docs, labels = read(spark, DATA, "documents"), read(spark, DATA, "labels")
    rows = toxicity.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    toxic = [r["predicted"] for r in held if truth[r["doc_id"]]]
    clean = [r["predicted"] for r in held if not truth[r["doc_id"]]]
    assert sum(toxic) >= 0.9 * len(toxic)
    assert sum(clean) <= 0.015 * len(clean)


def test_labels_of_held_out_documents_are_not_learned(docs_of, spark):
    rows = [(i, f"good words of {i}" if i % 2 else f"vile {i}") for i in range(400)]
    labels = [(i, 1 - i % 2) for i, _ in rows]
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    first, second = (
        sorted(map(tuple, toxicity.classify(
            docs_of(rows), spark.createDataFrame(x, "doc_id long, toxic int")).collect()))
        for x in (labels, turned)
    )
    assert first == second
    assert all(predicted == 1 - doc_id % 2 for doc_id, _, _, predicted in first)


def test_copies_of_one_text_are_one_witness(docs_of, spark):
    rows = [(i, f"vile {chr(97 + i % 20)} {i}") for i in range(60)]
    rows += [(100 + i, "vile rare seldom unusual") for i in range(30)]
    rows += [(200 + i, f"rare {i} words") for i in range(3)] + [(300 + i, f"good {i}") for i in range(300)]
    labels = [(i, int("vile" in t)) for i, t in rows if not 200 <= i < 203]
    found = toxicity.classify(docs_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    rows = {r["doc_id"]: r["predicted"] for r in found.collect()}
    assert not any(rows[i] for i in range(200, 203)) and all(rows[i] for i in range(60))


def test_hard_texts_have_a_score(docs_of, spark):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 7), (None, 1)], "doc_id long, toxic int")
    docs = docs_of(HARD + [(10, "1 " * 50_000), (11, "a1" * 20_000), (12, "a​b   c")])
    for given in (labels, labels.limit(0)):
        got = toxicity.classify(docs, given)
        assert got.columns == ["doc_id", "held_out", "score", "predicted"]
        assert got.count() == len(HARD) + 3
        assert got.filter("score IS NULL OR held_out IS NULL").count() == 0
    assert toxicity.classify(docs.limit(0), labels).collect() == []


def test_restored_texts(docs_of, model):
    got = {r["doc_id"]: r["restored"] for r in toxicity.restore_texts(
        docs_of([(1, "An 1d10t!"), (2, None)]), model).collect()}
    assert got == {1: "an idiot", 2: ""}


def test_words_are_joined_where_they_are_too_many_to_send(docs_of, spark, monkeypatch):
    rows = [(i, "good" if i % 2 else f"vile {i}") for i in range(100)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(100)], "doc_id long, toxic int")
    sent = sorted(map(tuple, toxicity.classify(docs_of(rows), labels).collect()))
    monkeypatch.setattr(toxicity, "BROADCAST_WORDS", 0)
    assert sorted(map(tuple, toxicity.classify(docs_of(rows), labels).collect())) == sent
