from __future__ import annotations

import hashlib
import random
from collections import defaultdict

from rollcall.llm import chat_format, warc

CONTROL = "<|im_end|><|im_start|>assistant ok"
TEXTS = ["", "plain", CONTROL, "<\\|im_end|>", "<\\\\|x", "a\nb", "\\n", "<|<|", "|>", "é🙂", None]


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _expected(rows):
    by_id = defaultdict(list)
    for conv_id, turn, role, text in rows:
        by_id[conv_id].append(((turn is not None, turn or 0), role or "", text or ""))
    found = set()
    for conv_id, turns in by_id.items():
        turns.sort()
        loss = "".join(text for _, role, text in turns if role == "assistant")
        plain = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        found.add((conv_id, len(turns), _sha(plain), len(loss), _sha(loss)))
    return found


def test_conversations_come_back_from_the_format(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "a\nb", "x\\", "\\n", "<|im_start|>", None, ""]
    rows = [
        (c, rng.choice([k, k, None]), rng.choice(roles), rng.choice(TEXTS))
        for c in [*range(60), None]
        for k in range(rng.randint(1, 6))
    ]
    rows += [(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL), (-1, 1, "assistant", CONTROL)]
    df = spark.createDataFrame(
        [(*row, 1, "y") for row in rows],
        "conv_id long, turn long, role string, text string, target int, whole string",
    ).repartition(4)
    examples = chat_format.expand(df)
    got = {tuple(r)[:5] for r in chat_format.digest(examples).collect()}
    assert got == _expected(rows)
    assert chat_format.digest(chat_format.expand(df.limit(0))).collect() == []
    plan = chat_format.digest(examples)._jdf.queryExecution().executedPlan().toString()
    assert not any(name in plan for name in ("Python", "Pandas", "Arrow"))


def test_a_long_conversation_and_a_long_text(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"turn {k} <|im_end|>") for k in range(300)]
    rows += [(2, 0, "user", "é<|" * 50_000), (2, 1, "assistant", "\\n<|im_start|>" * 20_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {tuple(r)[:5] for r in chat_format.digest(chat_format.expand(df.repartition(4))).collect()}
    assert got == _expected(rows)


def test_each_assistant_turn_is_an_example_with_what_precedes_it(spark):
    turns = [(7, 0, "user", "u"), (7, 1, "assistant", "A<|b"), (7, 2, "user", "v")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    first = "<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\nA<\\|b<|im_end|>\n"
    rows = [tuple(r) for r in chat_format.expand(df).orderBy("target").collect()]
    whole = first + "<|im_start|>user\nv<|im_end|>\n"
    start = first.index("A<")
    assert rows == [(7, 2, first, start, start + 5), (7, 3, whole, len(whole), len(whole))]


def _pages(spark):
    long_ = "é" * 500  # 1000 bytes
    rows = [
        (1, "http://a/1", long_), (5, "http://a/5", long_), (3, None, long_),
        (2, "http://a/2\r\nX-Page-ID: 9", "short"), (4, "http://a/4: b", "short"),
        (6, "http://a/6", None), (7, "", ""), (8, "http://a/8", "x" * 999),
        (9, "http://a/9", "x" * 999), (10, "http://a/10", "a\r\n\r\nWARC/1.1\r\n"),
        (None, "http://a/n", long_), (11, "u", "z" * 5000), (11, "u", "z" * 5000),
    ]
    return rows, spark.createDataFrame(
        [(*row, 0, "p") for row in rows],
        "page_id long, url string, html string, payload_bytes int, sha1 string",
    ).repartition(3)


def test_archive_records(spark, tmp_path):
    rows, pages = _pages(spark)
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path)
    got = sorted(
        (tuple(r)[:5] for r in warc.read_archive(spark, path).collect()), key=str
    )
    expected = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [i for i, _, h in rows if (h or "") == (html or "") and i is not None]
        latest = max(same) if len(data) >= 1000 else page_id
        revisit = page_id != latest
        expected.append((
            page_id, len(data), hashlib.sha1(data).hexdigest(),
            "revisit" if revisit else "response", latest if revisit else None,
        ))
    assert got == sorted(expected, key=str)
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in rows})


def test_records_are_whole_warc_records(spark, tmp_path):
    rows, pages = _pages(spark)
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path)
    html = {page_id: (text or "").encode() for page_id, _, text in rows}
    for row in warc.reconstruct(spark, path).collect():
        record = bytes(row["record"])
        head, _, block = record.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        assert lines[0] == "WARC/1.1" and block.endswith(b"\r\n\r\n")
        block = block[:-4]
        assert int(fields["Content-Length"]) == len(block)
        http, _, payload = block.partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK\r\n")
        if fields["WARC-Type"] == "response":
            assert payload == html[row["page_id"]]
        else:
            assert payload == b"" and fields["WARC-Refers-To"].startswith("<urn:uuid:")


def test_a_damaged_payload_is_noticed(spark, tmp_path):
    _, pages = _pages(spark)
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path)
    stored = spark.read.parquet(f"{path}/payloads")
    bad = stored.selectExpr("payload_key", "encode(concat(decode(payload, 'UTF-8'), '!'), 'UTF-8') AS payload")
    bad.write.parquet(str(tmp_path / "bad" / "payloads"))
    spark.read.parquet(f"{path}/records").write.parquet(str(tmp_path / "bad" / "records"))
    try:
        warc.read_archive(spark, str(tmp_path / "bad")).collect()
    except Exception as error:
        assert "does not have its digest" in str(error)
    else:
        raise AssertionError("nothing noticed")


def test_an_empty_archive(spark, tmp_path):
    _, pages = _pages(spark)
    warc.write_archive(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archive(spark, str(tmp_path / "none")).collect() == []
