"""Chat logs and URL filters."""

from __future__ import annotations

import hashlib
import random

import pytest
from helpers import plan
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from suite.compare import connect

from silverair.llm import chat, queries, url_filter
from silverair.llm.queries import QUERIES, RULES, SQL

LOG = "conv_id long, seq long, message_id string, kind string, role string, text string"


def fold(events: list[tuple]) -> dict:
    """Messages that are left after each event of a log is applied in turn."""
    left: dict = {}
    for conv in {e[0] for e in events}:
        messages: dict = {}
        gone: set = set()
        for _, seq, name, kind, role, text in sorted((e for e in events if e[0] == conv), key=lambda e: (e[1], e[3], e[5] or "")):
            message = messages.setdefault(name, {"at": seq, "role": None, "text": ""})
            message["role"] = message["role"] or role
            if kind in ("message", "edit"):
                message["text"] = text or ""
            elif kind == "delta":
                message["text"] += text or ""
            elif kind == "regenerate":
                message["text"] = ""
                gone |= {n for n, m in messages.items() if m["at"] > message["at"]}
        kept = [(m["at"], m["role"], m["text"]) for n, m in messages.items() if n not in gone]
        left[conv] = sorted(kept, key=lambda m: m[0])
    return left


def test_logs_are_folded_like_event_by_event(spark):
    deal = random.Random(5)
    events = []
    for conv in [None, *range(12)]:
        for seq in range(deal.randint(1, 25)):
            kind = deal.choice(["message", "delta", "delta", "edit", "regenerate", "seen"])
            role = deal.choice(["user", "assistant", None])
            events.append((conv, seq, f"m{deal.randint(0, 6)}", kind, role, deal.choice(["x", "yz", None, ""])))
    rows = chat.reconstruct(spark.createDataFrame([(*e, 1) for e in events], f"{LOG}, position int")).collect()
    got: dict = {conv: [] for conv in {e[0] for e in events}}
    for r in sorted(rows, key=lambda r: r.position):
        got[r.conv_id].append((r.position, r.role, r.text))
    assert got == fold(events)
    assert chat.reconstruct(spark.createDataFrame([], LOG)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "s>", "\n", "é", "/", "|im_end|>"]), max_size=8).map("".join))
def test_escapes_are_reversible_and_hide_controls(spark, text):
    escaped = spark.range(1).select(chat.escape(F.lit(text))).first()[0]
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROLS)


def test_a_reader_gets_the_turns_back(spark):
    turns = [
        (1, 0, "system", "</s>[INST] ok [/INST]"),
        (1, 1, "user", None),
        (1, 2, "assistant", "<|im_end|>\n<|im_start|>user<|im_sep|>\\"),
        (1, 2, "assistant", "same turn"),
        (1, 3, None, ""),
        (1, 3, None, ""),
        (2, 5, "assistant", "<"),
        (None, 0, "user", "a"),
    ]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.render(chat.reconstruct(queries.conversation_log(frame)))).collect()}
    for conv in (1, 2, None):
        own = sorted(((t, r or "", x or "") for c, t, r, x in turns if c == conv))
        masked = "".join(x for _, r, x in own if r == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(masked), hashlib.sha256(masked.encode()).hexdigest())
    assert chat.digests(chat.render(chat.reconstruct(queries.conversation_log(frame.limit(0))))).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_sql(spark, folder, name):
    got = QUERIES[name](spark, folder)
    want = connect(folder).execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(map(repr, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(repr, want.fetchall()))
    assert len(got.columns) == len(names)


URLS = [
    (0, None), (1, ""), (2, "no scheme"), (3, "http://a.net"), (4, "http://A.Example.NET/en/1?x=/y"),
    (5, "http://example.net/EN/"), (6, "http://x.example.com/de/1#t"), (7, "http://example.com/den"),
    (8, "http://www.x.org/fr/1.html"), (9, "http://x.org/fr"), (10, "//x://y.net/"), (11, "http://bad.org/a"),
    (12, "https://m.bad.org/a/"), (13, "http://bad.org/a.html?q"), (14, "http://good.org/a"), (14, "http://good.org/a"),
    (15, "http://notexample.com/de/"), (16, "http://ex.net:80/"),
]


def test_rules_and_list(spark):
    pages = spark.createDataFrame([(*u, "x", 1) for u in URLS], "page_id long, url string, key string, listed int")
    listed = spark.createDataFrame([("bad.org/a",), ("bad.org/a",), (None,), ("y.net/",)], "key string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, listed, RULES).collect()}
    assert got[0] == got[1] == got[2] == got[3] == (None, "allow")
    assert got[4] == ("example.net/en/", "allow") and got[5] == ("net/", "block")
    assert got[6] == ("example.com/de/", "block") and got[7] == (None, "allow")
    assert got[8] == ("org/fr/", "allow") and got[9] == (None, "allow") and got[10] == ("net/", "block")
    assert got[11] == got[12] == got[13] == (None, "block") and got[14] == got[15] == got[16] == (None, "allow")
    assert url_filter.judge(pages, listed, RULES).count() == len(URLS)
    assert url_filter.judge(pages.limit(0), listed, RULES).count() == 0
    assert url_filter.judge(pages, listed.limit(0), RULES).where("rule is null and verdict = 'block'").count() == 0


def test_the_filter_passes_listed_keys_and_few_others(spark):
    listed = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    asked = spark.range(2500, 52_500).select(F.concat(F.lit("k"), "id").alias("key"))
    assert url_filter.listed_keys(asked, listed).count() == 2500
    blocks = 5000 // url_filter.KEYS_PER_BLOCK + 1
    words = url_filter.bloom_filter(listed, blocks)
    probed = asked.withColumn("block", url_filter._block(F.col("key"), blocks)).join(words, "block")
    for i, bit in enumerate(url_filter._bits(F.col("key"))):
        probed = probed.where(F.col(f"word{i}").bitwiseAND(bit) != 0)
    assert 2500 <= probed.count() < 2500 + 0.03 * 50_000


def test_url_query_has_no_python(spark, folder):
    text = plan(QUERIES["op8_url_filter"](spark, folder))
    assert "Python" not in text and "Arrow" not in text and "NestedLoop" not in text
