"""Files: tolerant JSON lines, versioned snapshots, day files, feeds, frontmatter, notes, delimited text."""

from __future__ import annotations

import re
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "source", "title", "url", "date", "summary", "entity", "substance")])


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """The well-formed objects of path; blank, broken and non-object lines are left out, a missing path is empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).where(F.trim("value").startswith("{"))
    parsed = lines.select(F.from_json("value", T.StructType([*schema.fields, T.StructField("_broken", T.StringType())]), {"columnNameOfCorruptRecord": "_broken", "mode": "PERMISSIVE"}).alias("r"))
    return parsed.where("r is not null and r._broken is null").select(*[F.col(f"r.`{f.name}`") for f in schema.fields])


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines with sorted keys; absent fields are left out. Appending nothing adds no file."""
    if append and df.isEmpty():
        return
    df.select(*sorted(df.columns)).write.mode("append" if append else "overwrite").option("ignoreNullFields", "true").json(path)


class Snapshots:
    """Versions of a table under one path with a pointer to the one in force. A write makes a new version and then moves the
    pointer, so a reader never meets half a table and a plan may read what it replaces."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def version(self) -> str | None:
        p = f"{self.path}/pointer"
        if not exists(self.spark, f"{p}/*"):
            return None
        row = self.spark.read.text(p).agg(F.max("value")).head()
        return row[0] if row else None

    def read(self, schema: T.StructType) -> DataFrame:
        v = self.version()
        return self.spark.read.schema(schema).parquet(f"{self.path}/{v}") if v else self.spark.createDataFrame([], schema)

    def write(self, df: DataFrame) -> str:
        v = f"v{time.time_ns():020d}"
        df.write.parquet(f"{self.path}/{v}")
        self.spark.createDataFrame([(v,)], "value string").coalesce(1).write.mode("append").text(f"{self.path}/pointer")
        return v


def read_days(spark: SparkSession, pattern: str, schema: T.StructType = RECORD) -> tuple[DataFrame, DataFrame]:
    """(rows with day, days): the day is that of the file's name; a day whose file has no rows is still a day."""
    day = F.try_to_date(F.regexp_extract(F.col("_metadata.file_name"), r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")
    # names only, one a day: a scan leaves empty files out
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
    listed = spark.createDataFrame([(f.getPath().getName(),) for f in found], "name string")
    files = listed.select(F.try_to_date(F.regexp_extract("name", r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd").alias("day")).where("day is not null").distinct()
    lines = spark.read.text(pattern).select("value", day.alias("day")).where(F.trim("value").startswith("{"))
    rows = lines.select("day", F.from_json("value", schema).alias("r")).where("r is not null").select("day", "r.*")
    return rows, files


def read_rss(spark: SparkSession, path: str, limit: int = 600) -> DataFrame:
    """RSS items of XML files: title, url, published (null if undated), summary of at most `limit` characters. The weekday of an
    RFC 822 date is not read; names of zones other than offsets count as UTC."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("title", "link", "pubDate", "description")])
    items = spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)
    raw = F.regexp_replace(F.trim("pubDate"), r"^[A-Za-z]{3},\s*", "")
    raw = F.regexp_replace(raw, r"\s+(?:GMT|UTC|UT|Z)$", " +0000")
    raw = F.regexp_replace(raw, r"^(\d) ", "0$1 ")
    at = F.coalesce(F.try_to_timestamp(raw, F.lit("dd MMM yyyy HH:mm:ss xx")), F.try_to_timestamp(raw, F.lit("dd MMM yyyy HH:mm xx")), F.try_to_timestamp("pubDate"))
    return items.select(F.trim("title").alias("title"), F.trim("link").alias("url"), at.alias("published"), F.substring(F.coalesce("description", F.lit("")), 1, limit).alias("summary"))


SCALAR = re.compile(r"^([A-Za-z_][\w-]*):\s*(.*)$")


def parse_frontmatter(text: str | None) -> tuple[dict[str, str] | None, str | None, str | None]:
    """(fields, body, problem) of a text that opens with a line '---' and closes the block with another. Scalars and lists of
    scalars are read, lists joined by '|'. A text without such a block has null fields and no problem."""
    if text is None:
        return None, None, None
    lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    if lines[0].strip() != "---":
        return None, text, None
    end = next((i for i in range(1, len(lines)) if lines[i].strip() == "---"), None)
    if end is None:
        return None, text, "unclosed"
    fields: dict[str, str] = {}
    last = None
    for line in lines[1:end]:
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        item = re.match(r"^\s+-\s+(.*)$|^-\s+(.*)$", line)
        m = SCALAR.match(line)
        if m:
            last, value = m.group(1), m.group(2).strip()
            if value.startswith("[") and value.endswith("]"):
                value = "|".join(_unquoted(v) for v in value[1:-1].split(",") if v.strip())
            fields[last] = _unquoted(value)
        elif item and last:
            value = _unquoted((item.group(1) or item.group(2) or "").strip())
            fields[last] = f"{fields[last]}|{value}" if fields[last] else value
        elif not line[0].isspace():
            return None, text, "malformed"
    return fields, "\n".join(lines[end + 1 :]), None


def _unquoted(v: str) -> str:
    v = v.strip()
    if len(v) > 1 and v[0] == v[-1] and v[0] in "\"'":
        inner = v[1:-1]
        return inner.replace('\\"', '"').replace("\\\\", "\\") if v[0] == '"' else inner.replace("''", "'")
    return v


def frontmatter(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, fields (map), body, problem of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [parse_frontmatter(t if isinstance(t, str) else None) for t in b["t"]]
            yield pd.DataFrame({key: b["k"], "fields": [g[0] for g in got], "body": [g[1] for g in got], "problem": [g[2] for g in got]})

    kind = dict(texts.dtypes)[key]
    return texts.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"`{key}` {kind}, fields map<string,string>, body string, problem string")


def notes(lines: DataFrame) -> DataFrame:
    """Entries of note files: lines (file, pos, value) to (file, n, stamp, tags, link, body). A header line is
    '## <stamp> [#tag ...] [→ link]'; what follows up to the next is its body, with escaped headers ('\\## ') unescaped. n counts
    all entries of a file from 1."""
    from pyspark.sql import Window

    head = F.rlike("value", F.lit(r"^## \d{4}-\d{2}-\d{2}T\d{2}:\d{2}"))
    w = Window.partitionBy("file").orderBy("pos")
    numbered = lines.withColumn("n", F.sum(F.when(head, 1).otherwise(0)).over(w)).where("n > 0").withColumn("head", head)
    body = F.transform(F.array_sort(F.collect_list(F.when(~F.col("head"), F.struct("pos", "value")))), lambda x: F.regexp_replace(x["value"], r"^\\(## )", "$1"))
    entry = numbered.groupBy("file", "n").agg(F.max(F.when(F.col("head"), F.col("value"))).alias("h"), body.alias("lines"))
    return entry.select(
        "file", "n", F.regexp_extract("h", r"^## (\S+)", 1).alias("stamp"), F.regexp_extract_all("h", F.lit(r"(?:^|\s)#([\w-]+)"), 1).alias("tags"),
        F.nullif(F.regexp_extract("h", r"→\s*(\S+)\s*$", 1), F.lit("")).alias("link"), F.trim(F.array_join("lines", "\n"), F.lit("\n")).alias("body"),
    )


def between(text, start: str, end: str | None = None):
    """The part of a column after the first `start` and before the next `end`; '' without them."""
    after = F.get(F.split(text, re.escape(start), 2), F.lit(1))
    return F.coalesce(F.get(F.split(after, re.escape(end), 2), F.lit(0)) if end else after, F.lit(""))


def bundles(items: DataFrame) -> DataFrame:
    """items (title, url, date, summary) with their block of a prompt: '**title**', 'URL:', 'DATE:' for ISO dates and UNKNOWN,
    'Date:' for others, none for 'recent', and 'Summary:' if there is one."""
    dated = F.when((F.coalesce("date", F.lit("")) == "") | (F.col("date") == "recent"), F.lit(None)).when(
        (F.col("date") == "UNKNOWN") | F.rlike("date", F.lit(r"^\d{4}-\d{2}-\d{2}$")), F.concat(F.lit("DATE: "), "date")).otherwise(F.concat(F.lit("Date: "), "date"))
    block = F.concat_ws("\n", F.concat(F.lit("**"), F.coalesce("title", F.lit("")), F.lit("**")), F.concat(F.lit("URL: "), F.coalesce("url", F.lit(""))), dated,
                        F.when(F.coalesce("summary", F.lit("")) != "", F.concat(F.lit("Summary: "), "summary")))
    return items.withColumn("block", block)
