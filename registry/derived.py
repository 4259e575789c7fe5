"""News articles derived from the ``documents`` table.

The given tables hold no articles, so this SQL, which reads the same in Spark
and DuckDB, dresses each document as one: HTML in some bodies, mostly Arabic in some,
missing and empty fields, shared URLs, and publication dates in every form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ARTICLES_SQL = """
SELECT doc_id AS pos,
 CASE WHEN doc_id%41=0 THEN '' WHEN doc_id%43=0 THEN 'abc'
      ELSE '<b>'||substr(text,1,60)||'</b>' END AS title,
 CASE WHEN doc_id%5=0 THEN NULL WHEN doc_id%5=1 THEN ''
      ELSE 'Author '||CAST(doc_id%5 AS VARCHAR(10)) END AS author,
 CASE doc_id%6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'world'
      WHEN 3 THEN 'business' WHEN 4 THEN 'economy' ELSE 'sport' END AS category,
 CASE WHEN doc_id%12=8 THEN repeat('السلام عليكم، الحكومة المغربية ', CAST(floor(length(text)/20) AS INT) + 4)||text
      WHEN doc_id%7=0 THEN '<p>'||text||'</p> see http://ex.com/a?b=1 <i>end</i> @ #x'
      ELSE text END AS content,
 CASE doc_id%8 WHEN 0 THEN 'Hespress' WHEN 1 THEN 'BBC News' WHEN 2 THEN 'Barlamane'
      WHEN 3 THEN 'Akhbarona' WHEN 4 THEN 'Al Jazeera' WHEN 5 THEN 'Reuters'
      WHEN 6 THEN source ELSE 'Lakome' END AS source,
 CASE WHEN doc_id%37=5 THEN '' WHEN doc_id%10=9
      THEN 'https://news.example/'||CAST(doc_id-1 AS VARCHAR(20))
      ELSE 'https://news.example/'||CAST(doc_id AS VARCHAR(20)) END AS url,
 CASE WHEN doc_id%3=0 THEN NULL ELSE lang END AS language,
 CASE doc_id%11
  WHEN 0 THEN 'Mon, '||dd||' '||mon||' 2026 08:09:10 +0200'
  WHEN 1 THEN 'Tue, '||dd||' '||mon||' 2026 08:09:10 GMT'
  WHEN 2 THEN '2026-'||mm||'-'||dd||'T08:09:10+01:00'
  WHEN 3 THEN '2026-'||mm||'-'||dd||'T08:09:10'
  WHEN 4 THEN '2026-'||mm||'-'||dd||' 08:09:10'
  WHEN 5 THEN '2026-'||mm||'-'||dd
  WHEN 6 THEN dd||'/'||mm||'/2026'
  WHEN 7 THEN dd||'-'||mm||'-2026'
  WHEN 8 THEN '7:30' WHEN 9 THEN 'il y a 2 h' ELSE NULL END AS publication_date,
 '2026-05-'||dd||'T10:11:12' AS scraped_at
FROM (SELECT *, lpad(CAST(doc_id%28+1 AS VARCHAR(2)),2,'0') AS dd,
             lpad(CAST(doc_id%12+1 AS VARCHAR(2)),2,'0') AS mm,
             substr('JanFebMarAprMayJunJulAugSepOctNovDec',
                    CAST(doc_id%12*3+1 AS INT),3) AS mon
      FROM {documents}) t
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived raw articles, numbered by ``pos``."""
    return spark.sql(ARTICLES_SQL, documents=table(spark, sf_dir, "documents"))
