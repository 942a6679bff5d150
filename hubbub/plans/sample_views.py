"""Social-content tables derived from the sample tables, as one SQL text for Spark and DuckDB.

Only the ``@`` placeholders differ between the two engines.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

AS_OF = datetime(2024, 1, 31)

SOURCE_TABLES = ("region", "nation", "customer", "events", "documents", "embeddings")

_SPARK = {
    "@t0": "TIMESTAMP_NTZ '2024-01-31 00:00:00'",
    "@photos": "slice(array('a','b','c'), 1, CAST(doc_id % 4 AS INT))",
    "@tags": "slice(array(source, lang), 1, CAST(doc_id % 3 AS INT))",
    "@ms": "CAST(round(value * 1000) AS BIGINT) * INTERVAL '0.001' SECOND",
    "@topics": "array(concat('t', CAST(doc_id % 10 AS STRING)), concat('u', CAST(doc_id % 7 AS STRING)))",
    "@one": "array",
    "@nolist": "CAST(NULL AS ARRAY<STRING>)",
}
_DUCKDB = {
    "@t0": "TIMESTAMP '2024-01-31 00:00:00'",
    "@photos": "list_slice(['a','b','c'], 1, CAST(doc_id % 4 AS INT))",
    "@tags": "list_slice([source, lang], 1, CAST(doc_id % 3 AS INT))",
    "@ms": "CAST(round(value * 1000) AS BIGINT) * INTERVAL '1 millisecond'",
    "@topics": "['t' || CAST(doc_id % 10 AS STRING), 'u' || CAST(doc_id % 7 AS STRING)]",
    "@one": "list_value",
    "@nolist": "CAST(NULL AS VARCHAR[])",
}

VIEWS = {
    "fx_engagements": """
SELECT event_id AS id, user_id,
  CASE event_type WHEN 'view' THEN 'like' WHEN 'click' THEN 'comment' WHEN 'signup' THEN 'recast'
       WHEN 'purchase' THEN 'quote' ELSE 'report' END AS type,
  CASE WHEN event_id % 41 = 0 THEN 'user' WHEN event_id % 43 = 0 THEN 'comment' ELSE 'content' END
    AS target_ref,
  CASE WHEN event_id % 4 = 0 THEN 7 ELSE (user_id * 31 + event_id) % (@div(@documents, 5)) END AS content_id,
  ts AS created_at, ts AS updated_at
FROM {events}""",
    "fx_contents": """
SELECT doc_id AS content_id, doc_id % (@div(@documents, 7) + 8) AS author_id,
  CASE doc_id % 3 WHEN 0 THEN 'short' WHEN 1 THEN 'blog' ELSE 'image' END AS type,
  CASE WHEN doc_id % 10 = 0 THEN 'deleted' ELSE 'publish' END AS visibility,
  CASE WHEN doc_id % 29 = 0 THEN NULL ELSE concat(text, ' #', source, ' #', lang) END AS message,
  @photos AS photos,
  CASE WHEN doc_id % 13 = 0 THEN NULL ELSE doc_id % 17 END AS like_count,
  doc_id % 7 AS comment_count, doc_id % 5 AS recast_count, doc_id % 3 AS quote_count, lang,
  CASE WHEN doc_id % 11 = 0 THEN NULL ELSE @tags END AS hashtags,
  CAST(doc_id % 2 AS INT) AS version,
  @t0 - (doc_id % 45 + 1) * INTERVAL '1' DAY AS created_at,
  @t0 - (doc_id % 45) * INTERVAL '1' DAY - INTERVAL '1' HOUR AS updated_at
FROM {documents}""",
    "fx_users": """
SELECT c_custkey AS user_id, c_custkey % (@div(@customers, 15)) AS owner_account, c_name AS display_id,
  CASE WHEN c_custkey % 11 = 0 THEN 'hidden' ELSE 'publish' END AS visibility,
  @t0 - (c_custkey % 365) * INTERVAL '1' DAY AS created_at,
  c_custkey % 500 AS followed_count, c_custkey % 300 AS follower_count
FROM {customer}""",
    "fx_accounts": """
SELECT c_custkey AS account_id, concat('C', CAST(n_nationkey AS STRING)) AS country_code,
  r_name AS continent_code
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey
WHERE c_custkey % 10 <> 9""",
    "fx_feeditems": """
SELECT event_id AS id, user_id % (@div(@customers, 15)) AS viewer,
  CASE WHEN event_id % 4 = 0 THEN 7 ELSE (user_id * 31 + event_id) % (@div(@documents, 5)) END AS content_id,
  value - 20.0 AS score, CASE WHEN event_id % 2 = 0 THEN 'personal' ELSE 'global' END AS source,
  user_id AS seen_credential, ts AS seen_at,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN ts - @ms
       ELSE ts + @ms END AS off_screen_at, ts AS updated_at
FROM {events}""",
    "fx_contentinfo": """
SELECT doc_id AS content_id, lang AS language,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE @topics END AS topics
FROM {documents}""",
    "fx_filtering": """
SELECT doc_id AS content_id, lang AS language,
  CASE WHEN doc_id % 4 = 0 THEN NULL ELSE concat('t', CAST(doc_id % 10 AS STRING)) END AS class
FROM {documents} WHERE doc_id % 6 <> 0""",
    "fx_topic_vectors": """
SELECT CAST(e.label AS STRING) AS topic, e.embedding FROM {embeddings} e
JOIN (SELECT label, min(vec_id) AS vec_id FROM {embeddings} GROUP BY label) m
ON e.vec_id = m.vec_id""",
    "fx_messages": """
SELECT doc_id AS content_id,
  concat(text, CASE doc_id % 5
    WHEN 0 THEN ' see https://ex.am/ple?q=1&r=2 or www.ex-am.org/a_b #Été_1 #tag two'
    WHEN 1 THEN ' 😀★ r/news (10) points ☺ done ©® ⑤ 漢字!'
    WHEN 2 THEN ' สวัสดี http://a.b/c  end' ELSE '' END) AS message,
  @t0 - (doc_id % 45) * INTERVAL '1' DAY AS updated_at,
  CASE doc_id % 6
    WHEN 0 THEN '/Finance/Investing/Currencies & Foreign  Exchange' WHEN 1 THEN '/Finance/Banking'
    WHEN 2 THEN '/Sports/Team Sports' WHEN 3 THEN '/News' WHEN 4 THEN '/Finance/Investing'
    ELSE NULL END AS category,
  CASE WHEN lang = 'en' THEN NULL WHEN doc_id % 4 = 0 THEN 'a short: text'
    ELSE concat('This is the translation of the message number ', CAST(doc_id AS STRING),
      ' and it has enough words to be read by the service that tags english text only, ', source)
    END AS translated_en,
  CASE WHEN lang = 'en' OR doc_id % 9 = 0 THEN NULL ELSE lang END AS detected_language
FROM {documents}""",
    "fx_topics": """
SELECT concat('stored-', CAST(r_regionkey AS STRING)) AS topic_id,
  CASE r_regionkey WHEN 0 THEN 'finance' WHEN 1 THEN 'markets' ELSE lower(r_name) END AS slug,
  CASE WHEN r_regionkey = 1 THEN @one('finance') ELSE @nolist END AS parents_slug,
  CASE WHEN r_regionkey = 0 THEN @one('markets') ELSE @nolist END AS children_slug,
  TIMESTAMP_NTZ_2020 AS created_at, TIMESTAMP_NTZ_2020 AS updated_at
FROM {region}""".replace("TIMESTAMP_NTZ_2020", "@t0 - INTERVAL '400' DAY"),
    "fx_credentials": """
SELECT min(event_id) AS id, user_id AS seen_credential, min(ts) AS first_seen_at,
  max(ts) AS last_seen_at, count(*) AS count,
  round(avg(value) / 20, 6) AS post_reading_time_abs_skew,
  round(stddev_samp(value) / 100, 6) AS post_reading_time_abs_kurt,
  round(avg(event_id % 10) / 10, 6) AS post_reading_time_norm_std,
  round(stddev_samp(event_id % 7) / 10, 6) AS post_reading_time_difference_norm_std,
  CASE (user_id + event_id % 3) % 4 WHEN 0 THEN FALSE WHEN 1 THEN TRUE ELSE NULL END
    AS verification_status,
  CASE WHEN (user_id + event_id % 3) % 4 < 2
    THEN @t0 - (user_id * 7 % 240) * INTERVAL '1' MINUTE ELSE NULL END AS verified_at,
  max(ts) AS created_at, max(ts) AS updated_at
FROM {events} GROUP BY user_id, event_id % 3""",
    "fx_suspicious": """
SELECT id, seen_credential,
  CASE WHEN id % 5 = 0 THEN first_seen_at - INTERVAL '1' DAY ELSE first_seen_at END
    AS first_seen_at,
  last_seen_at, CASE WHEN id % 4 = 0 THEN NULL ELSE id % 2 = 0 END AS verification_status,
  CASE WHEN id % 4 = 0 THEN NULL ELSE @t0 - INTERVAL '30' MINUTE END AS verified_at,
  created_at
FROM {fx_credentials} WHERE seen_credential % 3 = 0""",
}

_REFERS_TO = {"fx_suspicious": ("fx_credentials",)}


def _fill(text: str, values: dict[str, str]) -> str:
    """``@`` placeholders by their values.

    ``@div(a, b)`` is a whole-number division, ``@documents`` and ``@customers`` are row counts.
    """
    for name, value in values.items():
        text = text.replace(name, value)
    whole = r"(\1 // \2)" if values is _DUCKDB else r"(\1 DIV \2)"
    text = re.sub(r"@div\((@\w+), (\d+)\)", whole, text)
    return re.sub(r"@(documents|customer)s?\b", r"(SELECT count(*) FROM {\1})", text)


def view_over(spark: SparkSession, name: str, **tables: DataFrame) -> DataFrame:
    """One derived table over the given source tables, which may be streams."""
    return spark.sql(_fill(VIEWS[f"fx_{name}"], _SPARK), **tables)


class Views:
    """The derived tables of one sample folder as Spark DataFrames, built when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        view = f"fx_{name}"
        if view not in VIEWS:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        text = _fill(VIEWS[view], _SPARK)
        tables = {t: getattr(self, t) for t in SOURCE_TABLES if f"{{{t}}}" in text}
        tables |= {v: getattr(self, v[3:]) for v in _REFERS_TO.get(view, ())}
        return view_over(self.spark, name, **tables)


def duckdb_sql(body: str, *views: str, recursive: bool = False) -> str:
    """``body`` for DuckDB, after the definitions of the derived tables it uses."""
    wanted: list[str] = []
    for view in views:
        for name in (*_REFERS_TO.get(f"fx_{view}", ()), f"fx_{view}"):
            if name not in wanted:
                wanted.append(name)
    definitions = []
    for name in wanted:
        text = _fill(VIEWS[name], _DUCKDB)
        for table in (*SOURCE_TABLES, *VIEWS):
            text = text.replace(f"{{{table}}}", table)
        definitions.append(f"{name} AS ({text}\n)")
    body = _fill(body, {"@t0": _DUCKDB["@t0"]}).strip()
    if body.upper().startswith("WITH "):
        definitions.append(body[5:])
        joined = ",\n".join(definitions)
    else:
        joined = ",\n".join(definitions) + "\n" + body if definitions else body
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + joined) if definitions else body
