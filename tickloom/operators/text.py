"""Text jobs over pages and conversations (TXT-1 .. TXT-4)."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.numeric import any_of, as_col
from tickloom.operators.ordered import computed_once, with_position

# Entities and markers in crawled text.
ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")]
MARKERS = ["<!--red_beg-->", "<!--red_end-->"]
# Item patterns of result pages (link first, then title).
HTML_ITEMS = [
    r'(?is)<h3[^>]*class="[^"]*vr-title[^"]*"[^>]*>\s*<a[^>]*href="([^"]+)"[^>]*>(.*?)</a>',
    r'(?is)<div[^>]*class="[^"]*titleWrap[^"]*"[^>]*>\s*<a[^>]*href="([^"]+)"[^>]*>\s*<div[^>]*>(.*?)</div>',
]


def decode_entities(c: Column) -> Column:
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def strip_html(c: Column | str) -> Column:
    """Plain text: entities decoded, tags removed, spaces collapsed."""
    text = decode_entities(F.coalesce(as_col(c), F.lit("")))
    for marker in MARKERS:
        text = F.replace(text, F.lit(marker), F.lit(""))
    return F.trim(F.regexp_replace(F.regexp_replace(text, "<[^>]+>", ""), r"\s+", " "))


def _tag(item: Column, name: str) -> Column:
    body = F.regexp_extract(item, f"(?is)<{name}>(.*?)</{name}>", 1)
    return F.trim(F.replace(F.replace(body, F.lit("<![CDATA["), F.lit("")), F.lit("]]>"), F.lit("")))


def _first(items: Column, limit: int | None) -> Column:
    return items if limit is None else F.slice(items, 1, limit)


def _feed_items(html: Column, limit: int | None) -> Column:
    items = F.regexp_extract_all(html, F.lit("(?is)<item>(.*?)</item>"), F.lit(1))
    parsed = F.transform(
        items,
        lambda i: F.struct(
            strip_html(_tag(i, "title")).alias("title"),
            decode_entities(_tag(i, "link")).alias("link"),
            decode_entities(_tag(i, "pubDate")).alias("published_at"),
            strip_html(_tag(i, "description")).alias("summary"),
            (_tag(i, "title") != "").alias("named"),
        ),
    )
    return _first(F.filter(parsed, lambda x: x["named"]), limit)


def _html_items(html: Column) -> Column:
    parts = []
    for pattern in HTML_ITEMS:
        links = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
        titles = F.regexp_extract_all(html, F.lit(pattern), F.lit(2))
        parts.append(
            F.zip_with(
                links,
                titles,
                lambda link, title: F.struct(
                    strip_html(title).alias("title"),
                    decode_entities(link).alias("link"),
                    F.lit("").alias("published_at"),
                    strip_html(title).alias("summary"),
                    F.lit(True).alias("named"),
                ),
            )
        )
    return F.filter(F.concat(*parts), lambda x: x["title"] != "")


def _by_title(links: Column) -> Column:
    """Links with their place, sorted by title and place: one repeats a title if its neighbour has it."""
    return F.array_sort(F.transform(links, lambda x, i: F.struct(x["title"].alias("by"), i.alias("i"), x.alias("item"))))


def page_items(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """TXT-1: news items of each page: feed items, or else result-page links; with `limit` the first ones only.

    Everything happens inside the page's row; nothing is shuffled. Of links with the same title the first one stays.
    """
    feed = computed_once(pages.select("page_id", "html", _feed_items(F.col("html"), limit).alias("__feed")))
    links = F.when(F.size("__feed") > 0, F.array().cast(feed.schema["__feed"].dataType)).otherwise(_html_items(F.col("html")))
    staged = computed_once(feed.select("page_id", "__feed", links.alias("__links")))
    staged = computed_once(staged.select("page_id", "__feed", _by_title(F.col("__links")).alias("__sorted")))
    before = F.concat(F.array(F.lit(None).cast("string")), F.transform("__sorted", lambda x: x["by"]))
    fresh = F.zip_with("__sorted", F.slice(before, 1, F.size("__sorted")), lambda x, title: F.when(x["by"].eqNullSafe(title), None).otherwise(x))
    placed = F.array_sort(F.transform(F.filter(fresh, lambda x: x.isNotNull()), lambda x: F.struct(x["i"].alias("i"), x["item"].alias("item"))))
    items = F.when(F.size("__feed") > 0, F.col("__feed")).otherwise(_first(F.transform(placed, lambda x: x["item"]), limit))
    source = F.when(F.size("__feed") > 0, "feed").otherwise("html")
    return staged.select("page_id", source.alias("source"), F.posexplode(items).alias("place", "item")).select(
        "page_id", "source", "place", "item.title", "item.link", "item.published_at", "item.summary"
    )


def clean_turns(turns: DataFrame, newest: int | None = None) -> DataFrame:
    """TXT-2: the turns of each conversation with a known role and no blank text; with `newest` only so many last ones."""
    if newest is not None:
        placed = with_position(turns, ["conv_id"], ["turn"], F.floor(F.col("turn") / 1000))
        turns = placed.where(F.col("pos") > F.col("group_rows") - newest)
    role = F.lower(F.coalesce("role", F.lit("user")))
    return (
        turns.select(
            "conv_id",
            "turn",
            F.when(role.isin("user", "assistant"), role).otherwise("user").alias("role"),
            F.trim(F.coalesce("text", F.lit(""))).alias("content"),
        )
        .where(F.col("content") != "")
    )


def latest_question(turns: DataFrame) -> DataFrame:
    """TXT-2: the newest user turn of each cleaned conversation."""
    mine = turns.where(F.col("role") == "user")
    return mine.groupBy("conv_id").agg(F.max_by("content", "turn").alias("question"))


# Words ignored in names, name pieces that match too much, well-known names.
IGNORED = ["股份", "控股", "集团", "有限公司", "公司", "-W", " ", "·", ".", "_", "-", "(", ")", "（", "）"]
COMMON_PIECES = ["中国", "国际", "控股", "股份", "集团"]
ALIASES = [
    ("茅台", "600519"), ("贵州茅台", "600519"), ("汾酒", "600809"), ("山西汾酒", "600809"), ("小米", "01810"),
    ("小米集团", "01810"), ("腾讯", "00700"), ("阿里", "09988"), ("美团", "03690"), ("宁德时代", "300750"),
    ("比亚迪", "002594"), ("格力", "000651"), ("美的", "000333"),
]


def mention_text(c: Column | str) -> Column:
    """Upper-case text without the ignored words."""
    text = F.upper(F.coalesce(as_col(c), F.lit("")))
    return reduce(lambda t, word: F.replace(t, F.lit(word), F.lit("")), IGNORED, text)


#: Lookup entries that go to the tasks with the plan; a larger catalogue is joined.
LOOKUP_ENTRIES = 200_000


def _characters(text: Column) -> Column:
    return F.split(text, "")


def _pairs(chars: Column) -> Column:
    """Distinct neighbours of a character array, as strings of two."""
    n = F.greatest(F.size(chars) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(chars, 1, n), F.slice(chars, 2, n), lambda x, y: F.concat(x, y)))


def _runs(chars: Column, size: int) -> Column:
    """Distinct strings of `size` neighbours."""
    n = F.greatest(F.size(chars) - size + 1, F.lit(0))
    return F.array_distinct(F.transform(F.slice(chars, 1, n), lambda c, i: F.concat(c, *[F.get(chars, i + k) for k in range(1, size)])))


def _catalogue(stocks: DataFrame) -> tuple[DataFrame, int]:
    """What names a stock: `kind`, `key`, `code`, `priority`, `symbol`, the best stock of each; and the length of code keys.

    `code`: a code, or a name of common pairs only, under its first characters (as many as the shortest of them has); `half`: a
    pair of characters of a name; `whole`: what only a whole question can be, a single character of a name or a part of it of common pairs.
    """
    known = stocks.where(F.length(F.trim("symbol")) > 0).select(F.upper(F.trim("symbol")).alias("symbol"), "priority", mention_text("symbol").alias("__code"), mention_text("company_name").alias("__name"))
    named = computed_once(known.where(F.length("__name") >= 2).withColumn("__chars", _characters(F.col("__name"))))
    common = F.array(*map(F.lit, COMMON_PIECES))
    plain = named.where(F.forall(_pairs(F.col("__chars")), lambda pair: F.array_contains(common, pair)))
    codes = known.where("__code <> ''").select("__code", "priority", "symbol").union(plain.select("__name", "priority", "symbol"))
    size = codes.agg(F.min(F.length("__code"))).first()[0] or 1
    chains = F.flatten(F.transform("__chars", lambda _, i: F.transform(F.sequence(F.lit(1), F.size("__chars") - i), lambda n: F.slice("__chars", i + 1, n))))
    odd = F.filter(chains, lambda x: F.forall(_pairs(x), lambda pair: F.array_contains(common, pair)))
    kinds = [
        codes.select(F.lit("code").alias("kind"), F.substring("__code", 1, size).alias("key"), F.col("__code").alias("code"), "priority", "symbol"),
        named.select(F.lit("half").alias("kind"), F.explode(_pairs(F.col("__chars"))).alias("key"), F.lit("").alias("code"), "priority", "symbol").where(~F.col("key").isin(COMMON_PIECES)),
        named.select(F.lit("whole").alias("kind"), F.explode(F.transform(odd, lambda x: F.array_join(x, ""))).alias("key"), F.lit("").alias("code"), "priority", "symbol"),
    ]
    best = reduce(DataFrame.unionByName, kinds).groupBy("kind", "key", "code").agg(F.min(F.struct("priority", "symbol")).alias("best"))
    return best.select("kind", "key", "code", "best.priority", "best.symbol"), size


def _in_row(entries: list, kind: str, priority: str):
    """A function of a key: the entries of the kind with that key, out of a hash table that is a constant of the plan."""
    own = [e for e in entries if e["kind"] == kind]
    buckets: list[list[dict]] = [[] for _ in range(max(1, len(own)))]
    for e in own:
        buckets[e["hash"] % len(buckets)].append({"key": e["key"], "code": e["code"], "best": {"priority": e["priority"], "symbol": e["symbol"]}})
    table = F.from_json(F.lit(json.dumps(buckets, ensure_ascii=False, default=str)), f"array<array<struct<key:string,code:string,best:struct<priority:{priority},symbol:string>>>>")

    def find(key: Column) -> Column:
        return F.filter(F.get(table, F.pmod(F.xxhash64(key), F.lit(len(buckets))).cast("int")), lambda e: e["key"] == key)

    return find


def mentioned_symbol(questions: DataFrame, stocks: DataFrame, entries: int = LOOKUP_ENTRIES) -> DataFrame:
    """TXT-3: the symbol a question mentions: an alias, else the best stock by `priority`.

    `questions` has (question_id, text), `stocks` (symbol, company_name, priority). A stock matches by its code, its
    name, a name that contains the question, or a two-character piece of its name that is not a common one. (A name that is in
    the question, or has it inside, shares a pair with it; what is left are names and questions of common pairs only, and
    questions of a single character.) Every piece keeps its best stock. A catalogue of at most `entries` pieces becomes a
    hash table in the plan, in which each question looks up its own pairs and code starts: no row is made for a piece and
    nothing but the question moves. Beyond that the pieces are joined.
    """
    text = questions.withColumn("__text", mention_text("text"))
    alias = F.lit(None).cast("string")
    for name, symbol in reversed(ALIASES):
        alias = F.when(F.col("__text").contains(name), symbol).otherwise(alias)
    text = computed_once(computed_once(text).withColumns({"__alias": alias, "__chars": _characters(F.col("__text"))}))
    lookup, size = _catalogue(stocks)
    if lookup.limit(entries + 1).count() <= entries:
        rows = lookup.withColumn("hash", F.xxhash64("key")).collect()
        priority = stocks.schema["priority"].dataType.simpleString()
        half, code, whole = (_in_row(rows, kind, priority) for kind in ("half", "code", "whole"))
        text = text.withColumns({"__pairs": _pairs(F.col("__chars")), "__runs": _runs(F.col("__chars"), size)})
        named = F.flatten(F.transform("__pairs", lambda p: F.transform(half(p), lambda e: e["best"])))
        coded = F.flatten(F.transform("__runs", lambda p: F.transform(F.filter(code(p), lambda e: F.contains(F.col("__text"), e["code"])), lambda e: e["best"])))
        exact = F.transform(whole(F.col("__text")), lambda e: e["best"])
        found = text.withColumn("__best", F.when(F.col("__alias").isNull(), F.array_min(F.concat(named, coded, exact))))
    else:
        found = text.join(_joined(text.where("__alias IS NULL"), lookup, size), "question_id", "left")
    return found.select("question_id", F.when(F.col("__text") == "", "").otherwise(F.coalesce("__alias", "__best.symbol", F.lit(""))).alias("symbol"))


def _joined(text: DataFrame, lookup: DataFrame, size: int) -> DataFrame:
    """`question_id` and `__best` by joins of the pieces, for catalogues of any size."""
    keys = {"half": _pairs(F.col("__chars")), "code": _runs(F.col("__chars"), size), "whole": F.array("__text")}
    asked = [text.select("question_id", "__text", F.lit(kind).alias("kind"), F.explode(pieces).alias("key")) for kind, pieces in keys.items()]
    hits = reduce(DataFrame.unionByName, asked).join(lookup, ["kind", "key"]).where(F.contains("__text", "code"))
    return hits.groupBy("question_id").agg(F.min(F.struct("priority", "symbol")).alias("__best"))


# Keywords of the intents, in order of precedence.
INTENT_WORDS = {
    "REPORT": ["报告", "分析报告", "答辩总结"],
    "WEB_STATUS": ["联网状态", "网络状态", "联网能力", "能不能联网", "web status"],
    "DATA": [
        "股票", "a股", "港股", "美股", "行情", "股价", "涨跌", "告警", "风险", "模型", "预测", "置信", "市场", "情绪",
        "潜力", "优选", "分析", "哪只",
    ],
    "WEB": [
        "黄金", "gold", "xau", "原油", "汇率", "美元指数", "新闻", "资讯", "昨天", "今日最新", "最新价格", "联网", "网络",
        "外部新闻", "搜索", "查一下", "查询", "查查", "web", "internet", "消息", "公告", "政策", "利好", "利空",
        "最近发生", "今天", "怎么了", "为什么",
    ],
}


def question_intent(question: Column | str, mode: Column | None = None, symbol: Column | None = None) -> Column:
    """TXT-4: intent of a question by keywords, or by the asked mode or a mentioned symbol."""
    text = F.lower(F.coalesce(as_col(question), F.lit("")))
    has = {name: any_of([text.contains(w) for w in words]) for name, words in INTENT_WORDS.items()}
    if mode is not None:
        has["REPORT"] = (F.lower(mode) == "report") | has["REPORT"]
    if symbol is not None:
        has["DATA"] = (F.trim(symbol) != "") | has["DATA"]
    result = F
    for name, condition in has.items():
        result = result.when(F.coalesce(condition, F.lit(False)), name)
    return result.otherwise("CASUAL")
