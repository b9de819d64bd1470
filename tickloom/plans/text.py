"""Registered queries for the text jobs (TXT)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.operators import text as tx
from tickloom.plans import fixtures as fx
from tickloom.plans.oracle import cte, with_ctes
from tickloom.plans.registry import query

LINK = r'<li><a href="([^"]*)">(.*?)</a></li>'
AS_FEED = "<item><title><![CDATA[$2]]></title><link>$1</link><description>$2 &amp;lt;b&amp;gt;</description></item>"
AS_RESULT = '<h3 class="x vr-title"> <a href="$1">$2</a></h3><h3 class="vr-title"><a href="$1?again">$2</a></h3>'


def crawled(spark, d) -> DataFrame:
    """Pages whose menu links are written as feed items (even ids) or as result links (odd ids)."""
    html = F.when(F.col("page_id") % 2 == 0, F.regexp_replace("html", LINK, AS_FEED)).otherwise(
        F.regexp_replace("html", LINK, AS_RESULT)
    )
    return fx.table(spark, d, "pages").select("page_id", html.alias("html"))


@query(
    "txt_01_page_items",
    r"""WITH links AS (SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">(.*?)</a></li>', 1)) AS link,
      unnest(regexp_extract_all(html, '<li><a href="([^"]*)">(.*?)</a></li>', 2)) AS title,
      generate_subscripts(regexp_extract_all(html, '<li><a href="([^"]*)">(.*?)</a></li>', 1), 1) AS i FROM pages),
    first AS (SELECT * FROM links QUALIFY page_id%2=0 OR row_number() OVER (PARTITION BY page_id, title ORDER BY i)=1),
    placed AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i)-1 AS place FROM first)
    SELECT page_id, CASE WHEN page_id%2=0 THEN 'feed' ELSE 'html' END AS source, place, title, link, '' AS published_at,
      title AS summary FROM placed""",
)
def _(spark, d):
    return tx.page_items(crawled(spark, d))


@query(
    "txt_02_clean_turns",
    """SELECT conv_id, turn, CASE WHEN lower(role) IN ('user','assistant') THEN lower(role) ELSE 'user' END AS role, trim(text) AS content
    FROM conversations WHERE trim(text)<>''""",
)
def _(spark, d):
    return tx.clean_turns(fx.table(spark, d, "conversations"))


@query(
    "txt_02_newest_turns",
    """SELECT conv_id, turn, trim(text) AS content
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations) WHERE r<=3 AND trim(text)<>''""",
)
def _(spark, d):
    return tx.clean_turns(fx.table(spark, d, "conversations"), newest=3).select("conv_id", "turn", "content")


@query(
    "txt_02_latest_question",
    """SELECT conv_id, arg_max(trim(text), turn) AS question FROM conversations
    WHERE trim(text)<>'' AND lower(role)<>'assistant' GROUP BY 1""",
)
def _(spark, d):
    return tx.latest_question(tx.clean_turns(fx.table(spark, d, "conversations")))


def questions(spark, d) -> DataFrame:
    """Every text of the conversations, and a short question for each: some name a code or a well-known stock."""
    n = F.col("conv_id") % 11
    ask = (
        F.when(n == 0, "贵州茅台 怎么了")
        .when(n == 1, F.concat(F.lit("code "), F.lpad((F.col("turn") % 25).cast("string"), 6, "0"), F.lit(" ?")))
        .when(n == 5, F.concat(F.lit("xarge"), F.col("turn").cast("string"), F.lit("x")))
        .when(n == 2, "r o m")
        .when(n == 3, "")
        .when(n == 4, F.col("text"))
        .otherwise(F.concat(F.lit("7"), F.col("conv_id").cast("string"), F.lit(" (今天) 报告")))
    )
    turns, place = fx.table(spark, d, "conversations"), F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    short = turns.select(place.alias("question_id"), ask.alias("text"), "turn")
    return short.unionByName(turns.select(F.concat(place, F.lit("-text")).alias("question_id"), "text", "turn"))


cte(
    "questions",
    """SELECT conv_id||'-'||turn AS question_id, CASE conv_id%11 WHEN 0 THEN '贵州茅台 怎么了' WHEN 1 THEN 'code '||lpad(CAST(turn%25 AS VARCHAR),6,'0')||' ?' WHEN 5 THEN 'xarge'||turn||'x'
      WHEN 2 THEN 'r o m' WHEN 3 THEN '' WHEN 4 THEN text ELSE '7'||conv_id||' (今天) 报告' END AS text, turn FROM conversations
    UNION ALL SELECT conv_id||'-'||turn||'-text', text, turn FROM conversations""",
)


def _mention(c: str) -> str:
    text = f"upper({c})"
    for word in tx.IGNORED:
        text = f"replace({text},'{word}','')"
    return text


@query(
    "txt_03_mentioned_symbol",
    with_ctes(
        ["questions"],
        f""", q AS (SELECT *, {_mention('text')} AS t FROM questions),
        s AS (SELECT CASE WHEN n_nationkey%2=0 THEN lpad(CAST(n_nationkey AS VARCHAR),6,'0') ELSE substr(n_name,1,3+n_nationkey%3)||n_nationkey END AS symbol, {_mention('n_name')} AS name, n_nationkey AS priority FROM nation),
        hits AS (SELECT question_id, arg_min(symbol, priority) AS symbol FROM q, s WHERE t<>'' AND (contains(t, symbol) OR (length(name)>=2 AND
          (contains(t, name) OR contains(name, t) OR len(list_filter(range(1, length(name)), lambda i: contains(t, substr(name, i, 2))))>0))) GROUP BY 1)
        SELECT q.question_id, CASE WHEN t='' THEN '' {' '.join(f"WHEN contains(t,'{a}') THEN '{c}'" for a, c in tx.ALIASES)} ELSE coalesce(h.symbol,'') END AS symbol
        FROM q LEFT JOIN hits h ON q.question_id=h.question_id""",
    ).replace(")\n, q AS", "),\nq AS"),
)
def _(spark, d):
    k = F.col("n_nationkey")  # codes of four to seven characters, some with letters
    stocks = fx.table(spark, d, "nation").select(
        F.when(k % 2 == 0, F.lpad(k.cast("string"), 6, "0")).otherwise(F.concat(F.substr("n_name", F.lit(1), 3 + k % 3), k.cast("string"))).alias("symbol"),
        F.col("n_name").alias("company_name"),
        F.col("n_nationkey").alias("priority"),
    )
    return tx.mentioned_symbol(questions(spark, d), stocks)


def _intent_sql(t: str, symbol: str) -> str:
    cases = []
    for name, words in tx.INTENT_WORDS.items():
        test = " OR ".join(f"contains({t},'{w}')" for w in words)
        cases.append(f"WHEN {symbol + '<>' + chr(39) * 2 + ' OR ' if name == 'DATA' else ''}{test} THEN '{name}'")
    return f"CASE {' '.join(cases)} ELSE 'CASUAL' END"


@query(
    "txt_04_question_intent",
    with_ctes(
        ["questions"],
        f"SELECT question_id, {_intent_sql('lower(text)', chr(39) * 2)} AS intent, {_intent_sql('lower(text)', 's')} AS with_symbol FROM (SELECT *, CASE WHEN turn=1 THEN '600519' ELSE '' END AS s FROM questions)",
    ),
)
def _(spark, d):
    symbol = F.when(F.col("turn") == 1, "600519").otherwise("")
    return questions(spark, d).select(
        "question_id",
        tx.question_intent("text").alias("intent"),
        tx.question_intent("text", symbol=symbol).alias("with_symbol"),
    )
