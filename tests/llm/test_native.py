"""Mixing, chat formatting and URL reputation."""

from __future__ import annotations

import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F

from catalog.compare import connect, difference
from shoptrail.llm import chat, hosts, mixing, queries
from tests.llm.fixtures import documents, odd_rows, prose, spaced

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, name):
    assert difference(spark, connect(FOLDER), FOLDER, name, queries.QUERIES[name], queries.SQL[name]) is None


def filled(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Targets by rounds: what a full source leaves goes to the others by weight."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    out, open_names, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_names:
        rate = left / sum(weight[s] for s in open_names)
        full = {s for s in open_names if weight[s] * rate >= 2 * sizes[s]}
        if not full:
            return {**out, **{s: weight[s] * rate for s in open_names}}
        out.update({s: 2.0 * sizes[s] for s in full})
        left -= sum(2 * sizes[s] for s in full)
        open_names -= full
    return out


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, "d": 70}, {None: 50, "Z": 10, "a": 3, "é": 900}, {"only": 7}, {"a": 0, "b": 9},
])
def test_targets_equal_rounds(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(filled(sizes))


def test_mix_takes_what_it_plans(spark):
    rows = odd_rows() + [(500 + k, " ".join(prose(k, 10 + k % 7))) for k in range(300)] + odd_rows()[:2]
    docs = documents(spark, rows)
    planned = mixing.plan_copies(docs).collect()
    assert len(planned) == len(rows)
    assert sorted((str(r.doc_id), r["size"]) for r in planned) == sorted((str(i), len(spaced(t))) for i, t in rows)
    assert all(r.taken <= 2 * r["size"] for r in planned)
    again = mixing.plan_copies(docs.repartition(7)).collect()
    assert sorted((str(r.doc_id), r.taken) for r in again) == sorted((str(r.doc_id), r.taken) for r in planned)
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "copy"]
    assert mixed.count() == sum(r.copies for r in planned)
    assert mixing.plan_copies(documents(spark, [])).collect() == []


def test_a_mixture_keeps_columns_of_any_name(spark):
    docs = documents(spark, odd_rows()).selectExpr("*", "'s' as source_size", "1 as target", "2 as taken", "3 as copies", "4 as doc", "5 as copy")
    mixed = mixing.mix(docs)
    assert mixed.columns == [c for c in docs.columns if c != "copy"] + ["copy"]
    rows = mixed.collect()
    assert rows and {(r.size, r.source_size, r.target, r.taken, r.copies, r.doc) for r in rows} == {(7, "s", 1, 2, 3, 4)}
    planned = {r.doc_id: r.copies for r in mixing.plan_copies(docs).collect()}
    assert all(sum(r.doc_id == i for r in rows) == n for i, n in planned.items() if i is not None)


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(30000).selectExpr("id as doc_id", "concat('w ', repeat('x ', cast(id % 9 as int))) as text", "concat('s', id % 4) as source")
    for r in mixing.plan_copies(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert r.taken == pytest.approx(r.target, rel=0.03)


# -- chat

CONV = "conv_id long, turn long, role string, text string"
NASTY = ["", None, "a & b &amp; &lt;| <| |>", "<|im_end|>\n<|im_start|>user\nx", "ends with <", "|im_start|>", "\n\n", "é漢\u2028 x", "<" * 5 + "|" * 5]


def test_chat_reads_back(spark):
    rows = [(k, t, ("user", "assistant", "system", None, "a\n<|b")[t % 5], NASTY[(k + t) % len(NASTY)]) for k in range(9) for t in range(10)]
    rows += [(50, None, "user", "late"), (50, 3, "assistant", "same"), (50, 3, "assistant", "same"), (None, 1, "user", "no id"), (60, 0, "assistant", "x" * 200000)]
    table = spark.createDataFrame(rows, CONV)
    out = chat.format_turns(chat.turns_from_columns(table))
    got = {r.conv_id: r for r in out.select("conv_id", "formatted", chat.parse_turns(F.col("formatted")).alias("back"), chat.loss_text(F.col("pieces")).alias("loss")).collect()}
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or ""))
        want = [(r[2] or "", r[3] or "") for r in own]
        assert [(t.role, t.text) for t in got[key].back] == want
        assert got[key].loss == "".join(t for role, t in want if role == "assistant")
        assert got[key].formatted.count(chat.OPEN) == got[key].formatted.count("<|im_end|>") == len(want)
    assert chat.format_turns(chat.turns_from_columns(spark.createDataFrame([], CONV))).collect() == []


def test_chat_layouts_by_fingerprint(spark):
    records = [
        ({"messages": [{"role": "User", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 3}, "messages", [("user", "q"), ("assistant", "a")]),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]}, "conversations", [("user", "q"), ("assistant", "")]),
        ({"prompt": "q", "response": "a", "score": 1}, "prompt_response", [("user", "q"), ("assistant", "a")]),
        ({"instruction": "do", "input": "this", "output": "done"}, "instruction_input", [("user", "do\nthis"), ("assistant", "done")]),
        ({"instruction": "do", "input": "", "output": "done"}, "instruction_input", [("user", "do"), ("assistant", "done")]),
        ({"question": "q", "answer": "a"}, "question_answer", [("user", "q"), ("assistant", "a")]),
        ({"something": "else"}, None, []),
    ]
    rows = [(k, json.dumps(r)) for k, (r, _, _) in enumerate(records)] + [(90, None), (91, "no json"), (92, "[]")]
    got = {r.conv_id: (r.mapping, [(t.role, t.text) for t in r.turns]) for r in chat.turns_from_json(spark.createDataFrame(rows, "conv_id long, raw string"), "raw").collect()}
    assert got == {**{k: (name, turns) for k, (_, name, turns) in enumerate(records)}, **{k: (None, []) for k in (90, 91, 92)}}
    frame = spark.createDataFrame([(1, "q", "a")], "conv_id long, prompt string, completion string")
    assert [tuple(t) for t in chat.turns_from_columns(frame).first().turns] == [("user", "q"), ("assistant", "a")]
    with pytest.raises(ValueError):
        chat.turns_from_columns(frame.select("conv_id"))


# -- URLs

URLS = [
    None, "", "no scheme/net/", "http://a.net/x", "http://A.Net", "https://example.net/en/9?x=/en/", "https://Sub.EXAMPLE.net/en/", "https://example.net/de/en/",
    "http://badexample.com/de/", "http://x.example.com/de/1#net/", "http://org/fr/", "http://é.org/fr/é", "http://a.org?u=/fr/", "http://net/", "x://y://example.com/de/",
    "http://a.co.uk/fr/", "http://user@host.com:80/p?q#f", "http:///path", "://net/a", "http://b.net#/x", "HTTP://WWW.EXAMPLE.NET/EN/",
]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in queries.URL_RULES:
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path) and (best is None or len(rule.pattern) > len(best.pattern)):
            best = rule
    return host, path, best


def test_urls_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS + URLS[3:5])], "page_id long, url string, host string")
    got = {r.page_id: r for r in hosts.judge(pages, queries.URL_RULES).collect()}
    assert len(got) == len(URLS) + 2
    for i, url in enumerate(URLS):
        host, path, rule = plain(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule.pattern if rule else None), url
        assert got[i].verdict == (rule.verdict if rule else got[i].verdict) in ("allow", "block")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert hosts.judge(empty, queries.URL_RULES).collect() == []


def test_reputation_shrinks_towards_the_domain(spark):
    def pages(host, bad, good, other=1):
        return [(f"http://{host}/", 1)] * bad + [(f"http://{host}/", 0)] * good + [(f"http://{host}/", None)] * other

    rows = pages("a.spam.com", 40, 0) + pages("b.spam.com", 38, 2) + pages("new.spam.com", 0, 0) + pages("c.spam.com", 0, 1)
    rows += pages("x.good.com", 1, 60) + pages("y.good.com", 0, 50) + pages("new.good.com", 1, 0) + pages("un.seen.org", 0, 0)
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, bad int")
    got = hosts.judge(table, (), outcome=F.col("bad"))
    verdicts = {r["host"]: r["verdict"] for r in got.select("host", "verdict").distinct().collect()}
    assert {h for h, v in verdicts.items() if v == "block"} >= {"a.spam.com", "b.spam.com", "new.spam.com"}
    assert {verdicts[h] for h in ("x.good.com", "y.good.com", "new.good.com", "un.seen.org")} == {"allow"}
    rates = {r["host"]: r["rate"] for r in hosts.reputations(hosts.address(table).select("host", "bad")).collect()}
    assert rates["a.spam.com"] > rates["b.spam.com"] > rates["c.spam.com"] > rates["x.good.com"]
    assert 0 < rates["y.good.com"] < rates["new.good.com"] < rates["new.spam.com"]


def test_control_conversation(spark):
    row = queries.QUERIES["op3_chat_format"](spark, FOLDER).filter("conv_id = -1").first()
    said = queries.CONTROL
    assert (row.n_turns, row.loss_chars) == (2, len(said))
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
