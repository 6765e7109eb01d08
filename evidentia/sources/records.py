"""Record collections as JSON, insert-only writes, products and schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Closed schemas of the evidence records; a field that is not listed is an error when records are read strictly.
_SOURCE = "struct<url:string,title:string,publisher:string,retrieved_at:date,sha256:string,license_note:string>"
_SPAN = "struct<page:int,line_start:int,line_end:int,quote:string>"
_REVIEW = "struct<status:string,reviewer:string,reviewed_at:date,note:string>"
_GENERATION = "array<struct<model:string,prompt_version:string,input_sha256:string>>"
SCHEMAS = {
    "parties": "id string, name string, short_name string, color string, website string",
    "programs": f"schema_version string, id string, dataset string, party_id string, title string, published_at date, period_start date, period_end date, source {_SOURCE}, leaves array<struct<id:string,text:string,reference:{_SPAN}>>, review {_REVIEW}, generation {_GENERATION}",
    "criteria": f"schema_version string, id string, dataset string, program_id string, party_id string, leaf_id string, title string, test string, tags array<string>, keywords array<string>, deadline date, reference {_SPAN}, assessment struct<status:string,method:string,score:int,evidence_ids:array<string>,assessed_at:date>, review {_REVIEW}, generation {_GENERATION}",
    "laws": f"schema_version string, id string, dataset string, title string, citation string, published_at date, source {_SOURCE}, passages array<struct<id:string,text:string,reference:{_SPAN}>>, review {_REVIEW}",
    "impacts": f"schema_version string, id string, dataset string, criterion_id string, law_id string, score int, confidence double, review {_REVIEW}, evaluation struct<status:string,previous_sha256:string>, generation {_GENERATION}",
    "votes": f"schema_version string, id string, dataset string, law_id string, type string, stage string, date date, scope string, source {_SOURCE}, groups array<struct<group:string,party_id:string,yes:int,no:int,abstain:int,absent:int,invalid:int,position:string>>, members array<struct<name:string,group:string,vote:string,source_row:int>>",
}


def load_records(spark: SparkSession, path: str, collection: str) -> DataFrame:
    """All records of a collection, one JSON document per file; a malformed one is an error."""
    return spark.read.schema(SCHEMAS[collection]).option("multiLine", True).option("mode", "FAILFAST").json(path)


def unknown_fields(spark: SparkSession, path: str, collection: str) -> DataFrame:
    """(rule, entity_id): top-level fields of the files that the collection's schema lacks."""
    known = T._parse_datatype_string(SCHEMAS[collection]).fieldNames()
    whole = spark.read.option("wholetext", True).text(path)
    keys = whole.select(F.explode(F.json_object_keys("value")).alias("entity_id")).distinct()
    return keys.where(~F.col("entity_id").isin(known)).select(F.lit("unknown field").alias("rule"), "entity_id")


def flatten_tree(spark: SparkSession, trees: DataFrame) -> DataFrame:
    """(program_id, node_id, parent_id, ordinal, title) of trees given as JSON text (program_id, tree).

    Levels are taken one after another by an iterative join-free explode of variants, to a depth that ends when no node
    has children left.
    """
    level = trees.select("program_id", F.parse_json("tree").alias("node"), F.lit(None).cast("string").alias("parent_id"), F.lit(0).alias("ordinal"))
    out = None
    while True:
        rows = level.select("program_id", F.variant_get("node", "$.id", "string").alias("node_id"), "parent_id", "ordinal", F.variant_get("node", "$.title", "string").alias("title"))
        out = rows if out is None else out.unionByName(rows)
        children = F.variant_get("node", "$.children", "array<variant>")
        level = level.select("program_id", F.variant_get("node", "$.id", "string").alias("parent_id"), F.posexplode(children).alias("ordinal", "node")).select("program_id", "node", "parent_id", "ordinal")
        if level.isEmpty():
            return out


def save_new(records: DataFrame, path: str, key: str = "id") -> int:
    """Append records whose key the table at path lacks; returns how many. An existing key is never overwritten."""
    spark = records.sparkSession
    try:
        known = spark.read.parquet(path).select(key)
        fresh = records.join(known, key, "left_anti").dropDuplicates([key])
    except Exception as e:  # a table that does not exist yet
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        fresh = records.dropDuplicates([key])
    fresh = fresh.cache()
    try:
        n = fresh.count()
        if n:
            fresh.write.mode("append").parquet(path)
        return n
    finally:
        fresh.unpersist()


def schemas_json() -> dict[str, str]:
    """Every collection's schema as JSON."""
    return {name: T._parse_datatype_string(ddl).json() for name, ddl in SCHEMAS.items()}


def strict_json_schema(kind: T.DataType) -> dict:
    """A closed JSON schema of a Spark type: all fields required, none beside them."""
    if isinstance(kind, T.StructType):
        return {"type": "object", "properties": {f.name: strict_json_schema(f.dataType) for f in kind}, "required": kind.fieldNames(), "additionalProperties": False}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": strict_json_schema(kind.elementType)}
    names = {T.BooleanType: "boolean", T.IntegerType: "integer", T.LongType: "integer", T.DoubleType: "number"}
    return {"type": names.get(type(kind), "string")}


def schema_faults(value, kind: T.DataType, at: str = "$") -> list[str]:
    """Where a value doesn't fit a type, by path only, so that no content is shown."""
    if value is None:
        return []
    if isinstance(kind, T.StructType):
        if not isinstance(value, dict):
            return [f"{at}: not an object"]
        extra = [f"{at}: unknown field" for k in value if k not in kind.fieldNames()]
        return extra + [x for f in kind for x in ([f"{at}.{f.name}: missing"] if f.name not in value else schema_faults(value[f.name], f.dataType, f"{at}.{f.name}"))]
    if isinstance(kind, T.ArrayType):
        return [f"{at}: not a list"] if not isinstance(value, list) else [x for i, v in enumerate(value) for x in schema_faults(v, kind.elementType, f"{at}[{i}]")]
    wanted = {T.BooleanType: bool, T.IntegerType: int, T.LongType: int, T.DoubleType: (int, float)}.get(type(kind), str)
    sound = isinstance(value, wanted) and (wanted is bool or not isinstance(value, bool))
    return [] if sound else [f"{at}: wrong type"]


def api_description(products: dict[str, DataFrame]) -> dict:
    """Paths and schemas of the products that are published."""
    return {"openapi": "3.1.0", "info": {"title": "evidence products", "version": "1"}, "paths": {f"/{n}.json": {"get": {"responses": {"200": {"content": {"application/json": {"schema": {"type": "array", "items": strict_json_schema(df.schema)}}}}}}} for n, df in products.items()}}


def later_wins(*reports: DataFrame, key: str) -> DataFrame:
    """Rows of several collections; for a key in more than one, that of the last."""
    rows = None
    for n, report in enumerate(reports):
        part = report.withColumn("__order", F.lit(n))
        rows = part if rows is None else rows.unionByName(part)
    best = rows.groupBy(key).agg(F.max("__order").alias("__order"))
    return rows.join(best, [key, "__order"], "left_semi").drop("__order")


def readings_index(editions: DataFrame) -> DataFrame:
    """Editions (document_id, pages array<struct<number, markdown, warnings>>) without their pages: counts and warned pages."""
    warned = F.transform(F.filter("pages", lambda p: F.size(p["warnings"]) > 0), lambda p: p["number"])
    return editions.select("document_id", F.size("pages").alias("page_count"), warned.alias("warned_pages"))


def edition_problems(editions: DataFrame) -> DataFrame:
    """(rule, entity_id): pages that are not 1 to n in order, texts that are not their pages joined, wrong digests."""
    numbers = F.transform("pages", lambda p: p["number"])
    text = F.array_join(F.transform("pages", lambda p: p["markdown"]), "\n\n")
    rules = {"page order": ~F.coalesce(numbers == F.sequence(F.lit(1), F.size("pages")), F.lit(False)) | (F.size("pages") == 0), "text differs": ~text.eqNullSafe(F.col("text")), "digest differs": ~F.sha2("text", 256).eqNullSafe(F.col("sha256")), "table unresolved": F.coalesce(F.col("text").rlike(r"\[(tbl-[^\]]+)\]\(\1\)"), F.lit(False))}
    out = None
    for rule, broken in rules.items():
        part = editions.where(broken).select(F.lit(rule).alias("rule"), F.col("document_id").cast("string").alias("entity_id"))
        out = part if out is None else out.unionByName(part)
    return out


def repaired_edition(old: DataFrame, redone: DataFrame) -> DataFrame:
    """Pages (document_id, number, markdown): flagged ones from redone where it has them, all others as they were."""
    new = redone.select("document_id", "number", F.col("markdown").alias("__new"))
    return old.join(new, ["document_id", "number"], "left").select("document_id", "number", F.when(F.col("flagged") & F.col("__new").isNotNull(), F.col("__new")).otherwise(F.col("markdown")).alias("markdown"), (F.col("flagged") & F.col("__new").isNull()).alias("flagged"))
