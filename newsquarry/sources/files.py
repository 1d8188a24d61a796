"""Readers of alias pools, company tables and exported documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POOL = "ticker string, company_name string, headquarters string, derived_from array<string>, names array<string>, subsidiaries array<string>, projects array<string>, locations array<string>, _broken string"
KINDS = ("names", "subsidiaries", "projects", "locations")


def alias_pool(spark: SparkSession, folder: str) -> DataFrame:
    """(ticker, alias, alias_kind, ix) of a folder of JSON documents, one a company; unreadable files are left out.

    A document without a ticker has that of its file's name.
    """
    docs = spark.read.schema(POOL).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").json(folder)
    stem = F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)
    docs = docs.where("_broken IS NULL").withColumn("ticker", F.upper(F.coalesce(F.nullif("ticker", F.lit("")), stem)))
    lists = F.array(*[F.struct(F.lit(k).alias("kind"), F.coalesce(F.col(k), F.array()).alias("names")) for k in KINDS])
    one = docs.select("ticker", F.explode(lists).alias("x")).select("ticker", F.col("x.kind").alias("alias_kind"), F.posexplode("x.names").alias("ix", "alias"))
    return one.select("ticker", F.trim("alias").alias("alias"), "alias_kind", "ix").where("length(alias) > 0")


def companies(spark: SparkSession, path: str) -> DataFrame:
    """The company table with either spelling of its headers; a byte-order mark and blank tickers don't matter."""
    raw = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    clean = raw.toDF(*[c.replace("﻿", "").strip().lower() for c in raw.columns])
    have = set(clean.columns)
    pick = lambda *names: F.coalesce(*[F.col(n) for n in names if n in have], F.lit(None).cast("string"))
    years = [F.col(f"`{c}`").alias(f"rev_{c}") for c in clean.columns if c.isdigit()]
    return clean.select(F.trim(pick("ticker", "code")).alias("ticker"), F.trim(pick("name", "company")).alias("company_name"), *years).where("length(ticker) > 0")


def ticker_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row for each article of exported company documents; malformed documents are left out."""
    schema = "ticker string, generated_at string, articles array<struct<article_id:string,title:string,published_at:string,location:string>>, _broken string"
    docs = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").json(path)
    return docs.where("_broken IS NULL").select("ticker", F.explode("articles").alias("a")).select("ticker", "a.*")


def by_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is listed; the planner broadcasts the list if it is small."""
    return df.join(keys.select(key).distinct(), key, "left_semi")


def vet_text(df: DataFrame, fields: tuple[str, ...] = ("title", "description", "sapo")) -> DataFrame:
    """``df`` with ``text``: the filled fields joined by a bar."""
    return df.withColumn("text", F.concat_ws(" | ", *[F.nullif(F.col(f), F.lit("")) for f in fields]))
