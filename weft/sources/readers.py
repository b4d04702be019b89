"""Readers for manifests, reports, transcripts and nested shards."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Candidate columns, first that exists wins (fixed values).
TEXT_COLUMNS = ("text", "transcription", "sentence", "transcript", "normalized_text")
AUDIO_COLUMNS = ("audio", "path", "file", "wav", "flac")


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON-lines manifest; blank lines are skipped, anything but an object fails."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_torn_manifest(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Complete records, and a broken last line of a file set aside; a broken line elsewhere fails."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("pos")).where("trim(value) <> ''")
    parsed = lines.withColumn("row", F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    last = lines.groupBy("file").agg(F.max("pos").alias("last"))
    good = F.expr("try_parse_json(value)").isNotNull() & F.col("value").rlike(r"^\s*\{")
    marked = parsed.join(last, "file").withColumn("good", good)
    broken = F.raise_error(F.concat(F.lit("broken line inside "), F.col("file"))).cast("boolean")
    sound = F.when(F.col("good") | (F.col("pos") == F.col("last")), F.col("good")).otherwise(broken)
    return marked.where(sound).select("row.*"), marked.where(~sound).select("file", "value")


def pick_column(df: DataFrame, candidates: tuple[str, ...]) -> str:
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"none of {candidates} in {df.columns}")


def read_shards(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parquet shards with detected text and audio columns, nothing else read."""
    df = spark.read.parquet(*paths)
    return df.select(F.col(pick_column(df, AUDIO_COLUMNS)).alias("audio"), F.col(pick_column(df, TEXT_COLUMNS)).alias("text"))


def explode_utterances(df: DataFrame, column: str = "utterances") -> DataFrame:
    """Rows of parallel arrays ``text, start, end, utt_id`` as one row an utterance; empty texts dropped."""
    def part(name: str, kind: str):  # a missing array leaves nulls
        return F.coalesce(F.col(column)[name], F.array().cast(f"array<{kind}>")).alias(name)

    zipped = F.arrays_zip(part("text", "string"), part("start", "double"), part("end", "double"), part("utt_id", "string"))
    rest = [x for x in df.columns if x != column]
    return df.select(*rest, F.posexplode(zipped).alias("n", "u")).select(*rest, "n", "u.text", "u.start", "u.end", "u.utt_id").where("trim(text) <> ''")


def read_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A tab-separated file without header and quotes; a line of another width fails."""
    raw = spark.read.text(path).where("value <> ''").select(F.split("value", "\t", -1).alias("p"))
    ok = F.when(F.size("p") == len(columns), F.col("p")).otherwise(F.raise_error(F.lit(f"expected {len(columns)} fields")).cast("array<string>"))
    return raw.select(ok.alias("p")).select(*[F.get("p", i).alias(c) for i, c in enumerate(columns)])


def join_by_stem(files: DataFrame, transcripts: DataFrame, key: str) -> DataFrame:
    """Files with their transcripts, by file name without folder and extension."""
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[A-Za-z0-9]+)?$", 1)
    return files.withColumn("stem", stem).join(transcripts.withColumn("stem", F.regexp_extract(key, r"([^/]+?)(?:\.[A-Za-z0-9]+)?$", 1)), "stem")


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """One row an item of JSON reports; files that are no reports are skipped."""
    item = "struct<case_id:string,seed:bigint,lang:string,text:string,cer:double,audio_sec:double>"
    raw = spark.read.option("multiLine", "true").schema(f"label string, items array<{item}>").json(path)
    return raw.where("size(items) > 0").select("label", F.explode("items").alias("i")).select("label", "i.*")


def log_values(spark: SparkSession, path: str) -> DataFrame:
    """``step, loss`` of training logs; lines without both are skipped."""
    v = F.col("value")
    return spark.read.text(path).select(F.regexp_extract(v, r"step[=: ]+(\d+)", 1).try_cast("bigint").alias("step"), F.regexp_extract(v, r"loss[=: ]+([0-9.eE+-]+)", 1).try_cast("double").alias("loss")).where("step is not null and loss is not null")


def tar_members(spark: SparkSession, path: str, suffix: str = ".wav", batch_bytes: int = 32 << 20) -> DataFrame:
    """``tar, path, content`` of the members of tar files, one task a file.

    Members go out in batches of bounded bytes; the archive itself must fit a
    task, as Spark reads whole binary files. Folders and other suffixes are
    left out. Join the result to transcripts with ``join_by_stem``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, data in zip(b["path"], b["content"]):
                rows, size = [], 0
                with tarfile.open(fileobj=io.BytesIO(data)) as tar:
                    for m in tar:
                        if not m.isfile() or not m.name.endswith(suffix):
                            continue
                        rows.append((name, m.name, tar.extractfile(m).read()))
                        size += m.size
                        if size >= batch_bytes:
                            yield pd.DataFrame(rows, columns=["tar", "path", "content"])
                            rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=["tar", "path", "content"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "tar string, path string, content binary")


def han_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """``stem, text`` of tab-separated lines of a file name and interleaved scripts: the last field with Han characters, these alone."""
    parts = spark.read.text(path).select(F.split("value", "\t").alias("p"))
    han = F.filter(F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(0))), lambda x: x.rlike("[一-鿿]"))
    return parts.where(F.size(han) > 0).select(F.regexp_extract(F.get("p", 0), r"([^/]+?)(?:\.[A-Za-z0-9]+)?$", 1).alias("stem"), F.regexp_replace(F.element_at(han, -1), "[^一-鿿]", "").alias("text"))
