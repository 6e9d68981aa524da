"""Files exchanged with outside labellers and arbiters, and the lemma table."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinleaf.functions.text import cleaned_labels, trimmed
from twinleaf.sources.records import exists

CATEGORIES = ["transfer-type", "feature", "mixed", "other"]
VERDICTS = ["duplicate", "different_transfer_type", "different_functionality", "uncertain"]
VERDICT_SCHEMA = "pair_id string, verdict string, reason string, batch_id int, line_no bigint"
LABEL_SCHEMA = "section_path string, category string, transfer_types array<string>, confidence double, reason string, pos int"


def json_value(text: Column) -> Column:
    """The variant of a text that is one JSON value and nothing else, else null.

    The parser ignores what follows a value. Inside an array and inside an object it
    can't: only a text that is right in both is one value.
    """
    listed, keyed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), F.try_parse_json(F.concat(F.lit('{"x":'), text, F.lit("}")))
    return F.when(keyed.isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull(), F.try_variant_get(listed, "$[0]", "variant"))


def parse_verdicts(lines: DataFrame, value: str = "value") -> DataFrame:
    """Columns pair_id, verdict, reason of JSON lines; blank, malformed, non-object lines and lines without a text as pair_id are dropped.

    A missing reason is an empty one, null stays null. An object that names a key twice
    counts as malformed. Other columns of `lines` (batch, line number) are kept.
    """
    rest = [c for c in lines.columns if c != value]
    v = F.col("_v")

    def text(path: str) -> Column:
        found = F.try_variant_get(v, path, "variant")
        return F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(v, path, "string"))

    lines = lines.withColumn("_t", trimmed(F.col(value))).where(F.startswith("_t", F.lit("{"))).withColumn("_v", json_value(F.col("_t")))
    reason = F.when(F.try_variant_get(v, "$.reason", "variant").isNull(), "").otherwise(F.try_variant_get(v, "$.reason", "string"))
    return lines.where("_v is not null").select(*rest, text("$.pair_id").alias("pair_id"), text("$.verdict").alias("verdict"), reason.alias("reason")).where("pair_id is not null and pair_id <> ''")


def verdict_lines(files: DataFrame) -> DataFrame:
    """(batch_id, line_no, value) of whole batch_NNNN.jsonl files; files of other names have no batch_id. Lines end where Unicode has them end."""
    named = files.select("value", F.regexp_extract(F.col("_metadata.file_name"), r"^batch_(\d+)\.jsonl$", 1).try_cast("int").alias("batch_id"))
    lines = F.split("value", r"\R|[\x{0B}\x{0C}\x{1C}-\x{1E}]")
    return named.select("batch_id", F.posexplode(lines).alias("line_no", "value")).withColumn("line_no", F.col("line_no").cast("bigint"))


def valid_verdicts(lines: DataFrame) -> DataFrame:
    """pair_id, verdict, reason, batch_id, line_no of verdict_lines() with a known verdict."""
    return parse_verdicts(lines).where(F.col("verdict").isin(VERDICTS)).select("pair_id", "verdict", "reason", "batch_id", "line_no")


def read_verdicts(spark: SparkSession, directory: str, batches: DataFrame | None = None) -> DataFrame:
    """Valid verdicts of batch_NNNN.jsonl files with batch_id and line_no; only files of the given batches (a table of batch_id), if any are given.

    Files are read whole (a batch is small), so that lines keep their order.
    """
    if not _matches(spark, f"{directory}/batch_*.jsonl"):
        return spark.createDataFrame([], VERDICT_SCHEMA)
    lines = verdict_lines(spark.read.text(f"{directory}/batch_*.jsonl", wholetext=True))
    if batches is not None:
        lines = lines.join(batches.select("batch_id").distinct(), "batch_id", "left_semi")
    return valid_verdicts(lines)


def answered_batches(spark: SparkSession, directory: str) -> DataFrame:
    """batch_id of each verdict file that is there, whatever it holds."""
    if not _matches(spark, f"{directory}/batch_*.jsonl"):
        return spark.createDataFrame([], "batch_id int")
    files = spark.read.format("binaryFile").load(f"{directory}/batch_*.jsonl")  # of the listing, no content is read
    return files.select(F.regexp_extract("path", r"batch_(\d+)\.jsonl$", 1).try_cast("int").alias("batch_id")).where("batch_id is not null")


def _matches(spark: SparkSession, pattern: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def parse_section_labels(df: DataFrame, value: str = "value") -> DataFrame:
    """Labels of sections from JSON text: {"sections": [...]} or a bare list; another shape gives none, malformed JSON raises.

    pos is an element's place. Rows of an unknown category or without a section are
    dropped; label values are cleaned (cleaned_labels).
    """
    element = T.StructType().add("section_path", "string").add("category", "string").add("transfer_types", T.StringType()).add("confidence", "double").add("reason", "string")
    whole = F.col(value)
    df = df.withColumn("_ok", F.when(json_value(whole).isNull(), F.raise_error(F.lit("malformed JSON in the section labels"))).otherwise(F.lit(True)))
    listed = F.when(F.col("_ok") & whole.rlike(r"^\s*\["), F.from_json(whole, T.ArrayType(element)))
    inside = F.when(F.col("_ok") & whole.rlike(r"^\s*\{"), F.from_json(whole, T.StructType().add("sections", T.ArrayType(element)))["sections"])
    rows = df.select(F.posexplode(F.coalesce(listed, inside)).alias("pos", "e")).select("pos", "e.*")
    types = cleaned_labels(F.from_json("transfer_types", "array<string>"))
    return rows.where(F.col("category").isin(CATEGORIES) & (F.col("section_path") != "")).select("section_path", "category", types.alias("transfer_types"), "confidence", "reason", "pos")


def read_section_labels(spark: SparkSession, path: str) -> DataFrame:
    """Labels of a JSON file; none if the file is absent."""
    if not exists(spark, path):
        return spark.createDataFrame([], LABEL_SCHEMA)
    return parse_section_labels(spark.read.text(path, wholetext=True))


def read_lemmas(spark: SparkSession, path: str) -> DataFrame:
    """The lemma table (token, lemma) at a path: Parquet, or by the ending .json one JSON object of strings. Empty if it is absent or can't be read."""
    empty = spark.createDataFrame([], "token string, lemma string")
    if not exists(spark, path):
        return empty
    if path.endswith(".json"):
        pairs = F.from_json("value", "map<string,string>", {"allowSingleQuotes": "false"})
        return spark.read.text(path, wholetext=True).where(json_value(F.col("value")).isNotNull()).select(F.explode(pairs).alias("token", "lemma")).where("lemma is not null")
    try:
        found = spark.read.parquet(path)
        return found.select("token", "lemma") if {"token", "lemma"} <= set(found.columns) else empty
    except (AnalysisException, Py4JJavaError):  # a corrupt cache counts as empty
        return empty


def write_lemmas(df: DataFrame, path: str) -> None:
    df.select("token", "lemma").dropDuplicates(["token"]).orderBy("token").write.mode("overwrite").parquet(path)


def batch_documents(batches: DataFrame) -> DataFrame:
    """(batch_id, value): one JSON object for each batch, its pairs in the order of score (falling) and pair_id; a batch is of bounded size."""
    pair = F.struct(F.negative("score").alias("_s"), "pair_id", F.struct("pair_id", "score", "tier", "a", "b").alias("p"))
    listed = F.transform(F.array_sort(F.collect_list(pair)), lambda x: x["p"])
    return batches.groupBy("batch_id").agg(listed.alias("pairs")).select("batch_id", F.to_json(F.struct("batch_id", "pairs"), {"ignoreNullFields": "false"}).alias("value"))


def write_batches(batches: DataFrame, directory: str) -> None:
    """One file batch_NNNN.json for each batch; earlier ones are removed.

    Spark writes a folder for each; their single files are then moved to their names,
    which touches no content.
    """
    spark = batches.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(directory).getFileSystem(spark._jsc.hadoopConfiguration())
    for old in files.globStatus(path(f"{directory}/batch_*.json")) or []:
        files.delete(old.getPath(), True)
    work = f"{directory}/_writing"
    name = F.concat(F.format_string("batch_%04d", "batch_id"), F.lit(".json"))
    batch_documents(batches).select(name.alias("file"), "value").write.mode("overwrite").partitionBy("file").text(work)
    for part in files.globStatus(path(f"{work}/file=*/part-*")) or []:
        named = part.getPath().getParent().getName().removeprefix("file=")
        files.rename(part.getPath(), path(f"{directory}/{named}"))
    files.delete(path(work), True)
