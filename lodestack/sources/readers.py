"""Readers of registries, manifests and archives as DataFrames. All go through Spark's own file sources."""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Archives over this many expanded bytes a member are reported, not expanded.
MEMBER_MOST = 256 << 20


class _Unique(yaml.SafeLoader):
    """YAML in which a repeated key or one that is no string is an error."""


def _mapping(loader: yaml.Loader, node: yaml.MappingNode) -> dict:
    keys = [loader.construct_object(k, deep=True) for k, _ in node.value]
    if any(not isinstance(k, str) for k in keys) or len(set(keys)) < len(keys):
        raise yaml.YAMLError(f"repeated key or key that is no string, at {node.start_mark}")
    return {k: loader.construct_object(v, deep=True) for k, (_, v) in zip(keys, node.value, strict=True)}


_Unique.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, _mapping)


def parse_yaml(text: str) -> object:
    return yaml.load(text, Loader=_Unique)


def yaml_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, document as JSON, error) of each YAML file under a path or glob."""
    import json

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p, sha, data in zip(pdf["path"], pdf["sha256"], pdf["content"], strict=True):
                try:
                    rows.append((p, sha, json.dumps(parse_yaml(bytes(data).decode("utf-8")), sort_keys=True, default=str), None))
                except (yaml.YAMLError, UnicodeDecodeError) as e:
                    rows.append((p, sha, None, str(e)))
            yield pd.DataFrame(rows, columns=["path", "sha256", "document", "error"])

    files = files_of(spark, path, "*.yaml", content=True)
    return files.select("path", "sha256", "content").mapInPandas(parse, "path string, sha256 string, document string, error string")


def files_of(spark: SparkSession, path: str, pattern: str = "*", content: bool = False) -> DataFrame:
    """(path, size_bytes, sha256[, content]) of all files under a path, hidden ones left out."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    df = df.where(~F.col("path").rlike(r"/[._][^/]*(/|$)") | F.lit(content))
    return df.select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"), *(["content"] if content else []))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(line, sha256, file, problem) of a checksum manifest: one line '<64 hex>  <file>' each."""
    lines = spark.read.text(path).where("trim(value) != ''")
    sha, name = F.regexp_extract("value", "^([0-9a-f]{64})  (.+)$", 1), F.regexp_extract("value", "^([0-9a-f]{64})  (.+)$", 2)
    rows = lines.select(F.col("value").alias("line"), sha.alias("sha256"), name.alias("file"))
    repeated = rows.where("file != ''").groupBy(F.lower("file").alias("key")).agg(F.count("*").alias("n"))
    joined = rows.join(repeated, F.lower("file") == F.col("key"), "left")
    bad = F.when(F.col("sha256") == "", "malformed").when(F.col("file").rlike(r"(^/|(^|/)\.\.(/|$)|\\)"), "unsafe path").when(F.col("n") > 1, "repeated path")
    return joined.select("line", "sha256", "file", bad.alias("problem"))


def csv_catalog(spark: SparkSession, path: str, schema: StructType, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a proper unique decimal key, and the others with the reason."""
    df = spark.read.csv(path, header=True, schema=schema, enforceSchema=False, mode="FAILFAST", multiLine=True, escape='"')
    n = df.groupBy(key).agg(F.count("*").alias("__n"))
    joined = df.join(n, df[key].eqNullSafe(n[key])).drop(n[key])
    reason = F.when(~F.coalesce(F.col(key).cast("string").rlike("^[0-9]+$"), F.lit(False)), "key is no decimal number").when(F.col("__n") > 1, "repeated key")
    marked = joined.withColumn("reason", reason).drop("__n")
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def xml_rows(spark: SparkSession, path: str, attributes: StructType, row_tag: str = "row") -> DataFrame:
    """Attributes of <row .../> elements; the schema names them without a prefix."""
    prefixed = StructType([f.__class__(f"_{f.name}", f.dataType) for f in attributes])
    df = spark.read.format("xml").option("rowTag", row_tag).schema(prefixed).load(path)
    return df.select(*[F.col(f"_{f.name}").alias(f.name) for f in attributes])


def json_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")


def geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """(properties as JSON, type, coordinates as JSON) of each feature; coordinates of any depth stay JSON."""
    doc = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
    each = F.variant_get("v", "$.features", "array<variant>")
    return doc.select(F.explode(each).alias("f")).select(
        F.variant_get("f", "$.geometry.type", "string").alias("type"), F.to_json(F.variant_get("f", "$.properties", "variant")).alias("properties"), F.to_json(F.variant_get("f", "$.geometry.coordinates", "variant")).alias("coordinates")
    )


def sitemap(spark: SparkSession, path: str) -> DataFrame:
    """Locations of a sitemap; a document with entity declarations is refused."""
    doc = spark.read.text(path, wholetext=True)
    checked = F.when(F.col("value").contains("<!ENTITY"), F.raise_error(F.lit("entity declarations are not read")).cast("string")).otherwise(F.col("value"))
    return doc.select(F.explode(F.regexp_extract_all(checked, F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))).alias("url")).select(F.replace("url", F.lit("&amp;"), F.lit("&")).alias("url"))


def archive_members(spark: SparkSession, path: str, pattern: str = "*.zip") -> DataFrame:
    """(path, member, size_bytes, packed_bytes, problem) of ZIP and TAR archives, from their directories alone."""

    def audit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p, data in zip(pdf["path"], pdf["content"], strict=True):
                seen: set[str] = set()
                try:
                    if p.endswith(".zip"):
                        entries = [(i.filename, i.file_size, i.compress_size) for i in zipfile.ZipFile(io.BytesIO(data)).infolist() if not i.is_dir()]
                    else:
                        entries = [(m.name, m.size, m.size) for m in tarfile.open(fileobj=io.BytesIO(data)) if m.isfile()]
                except (zipfile.BadZipFile, tarfile.TarError) as e:
                    rows.append((p, None, None, None, f"unreadable: {e}"))
                    continue
                for name, size, packed in entries:
                    bad = "unsafe path" if name.startswith("/") or ".." in name.split("/") or "\\" in name else "too large" if size > MEMBER_MOST or size > 200 * max(packed, 1) + 4096 else "collision" if name.casefold() in seen else None
                    seen.add(name.casefold())
                    rows.append((p, name, size, packed, bad))
            yield pd.DataFrame(rows, columns=["path", "member", "size_bytes", "packed_bytes", "problem"]).astype({"size_bytes": "Int64", "packed_bytes": "Int64"})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "content").mapInPandas(audit, "path string, member string, size_bytes long, packed_bytes long, problem string")


def unread(current: DataFrame, done: DataFrame, key: str = "sha256") -> DataFrame:
    """Incremental read: what is not yet among the digests already processed."""
    return current.join(done.select(key).distinct(), key, "left_anti")
