"""Mentions and page items against plain Python."""

from __future__ import annotations

import random
import re

import pytest

from tickloom.operators import text as tx


def plain(text: str | None) -> str:
    text = (text or "").upper()
    for word in tx.IGNORED:
        text = text.replace(word, "")
    return text


def brute(question: str | None, stocks: list[tuple]) -> str:
    t = plain(question)
    if not t:
        return ""
    for name, symbol in tx.ALIASES:
        if name in t:
            return symbol
    found = []
    for symbol, company, priority in stocks:
        if not (symbol or "").strip():
            continue
        code, name = plain(symbol), plain(company)
        pairs = {name[i : i + 2] for i in range(len(name) - 1)} - set(tx.COMMON_PIECES)
        if (code and code in t) or (len(name) >= 2 and (name in t or t in name or any(p in t for p in pairs))):
            found.append((priority, symbol.strip().upper()))
    return min(found)[1] if found else ""


def catalogue(rng: random.Random) -> list[tuple]:
    chars = "中国际油气银行科技ab"
    return [(rng.choice([f"{rng.randrange(1000):06d}", f"A{k}", f" hk{k} ", "", None]), rng.choice(["中国", "中国国际", "中国际", "股份", "x", None, "".join(rng.choices(chars, k=rng.randrange(1, 7)))]), k) for k in rng.sample(range(1000), 40)]


@pytest.mark.parametrize("entries", [tx.LOOKUP_ENTRIES, 3])
def test_mentions_against_every_stock(spark, entries):
    rng = random.Random(7)
    stocks = catalogue(rng)
    asked = [None, "", " ", "中", "中国", "国际", "中国际", "中国国", "小米 a1", "00", "a", "a.1", "𠀀中国𠀀油"]
    asked += ["".join(rng.choices("中国际油气银行科技ab01 xyz", k=rng.randrange(1, 9))) for _ in range(150)]
    asked += [f"请问 {s[0]} 如何" for s in stocks] + [f"{s[1]}?" for s in stocks]
    questions = spark.createDataFrame([(str(k), q) for k, q in enumerate(asked)], "question_id string, text string")
    got = tx.mentioned_symbol(questions, spark.createDataFrame(stocks, "symbol string, company_name string, priority int"), entries=entries)
    assert {r["question_id"]: r["symbol"] for r in got.collect()} == {str(k): brute(q, stocks) for k, q in enumerate(asked)}


def test_mentions_move_no_pieces(spark):
    questions = spark.createDataFrame([("1", "银行")], "question_id string, text string")
    stocks = spark.createDataFrame([("600000", "浦发银行", 1)], "symbol string, company_name string, priority int")
    plan = tx.mentioned_symbol(questions, stocks)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "explode" not in plan.lower()
    empty = tx.mentioned_symbol(questions, stocks.limit(0)).collect()
    assert [r["symbol"] for r in empty] == [""]


def test_first_link_of_each_title(spark):
    titles = [random.Random(2).choice("abcde") for _ in range(30)]
    html = "".join(f'<h3 class="vr-title"><a href="/{k}">{t}</a></h3>' for k, t in enumerate(titles))
    rows = [(1, html), (2, "<p>nothing</p>"), (3, None), (4, "<item><title>x</title><link>/l</link></item><item><title>x</title></item>" + html)]
    got = tx.page_items(spark.createDataFrame(rows, "page_id int, html string")).orderBy("page_id", "place").collect()
    want = [(f"/{titles.index(t)}", t) for t in sorted(set(titles), key=titles.index)]
    assert [(r["link"], r["title"]) for r in got if r["page_id"] == 1] == want
    assert [(r["source"], r["link"]) for r in got if r["page_id"] == 4] == [("feed", "/l"), ("feed", "")]
    assert {r["page_id"] for r in got} == {1, 4}
    assert re.fullmatch(r"/\d+", tx.page_items(spark.createDataFrame(rows[:1], "page_id int, html string"), limit=1).collect()[0]["link"])
