"""CSV, TSV, JSON and Markdown inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def conform(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order: missing ones null, others dropped."""
    have = set(frame.columns)
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """RFC 4180: doubled quotes and line ends inside quotes; all columns strings unless a schema is given."""
    frame = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', maxCharsPerColumn=-1)
    return conform(frame, schema) if schema else frame


def read_entries(spark: SparkSession, path: str, volume: int | None = None) -> DataFrame:
    """Entries of one volume or all; the volume is compared as text without spaces."""
    frame = read_csv(spark, path)
    return frame if volume is None else frame.filter(F.trim("volume") == str(volume))


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Unquoted tab-separated values with a header."""
    return spark.read.csv(path, sep="\t", header=True, quote="", escape="")


REGION = T.StructType.fromDDL(
    "id string, type string, reading_order int, page_side string, insert_id string, insert_state string, line_count int, page_number string, "
    "transcription struct<status:string,skipped:boolean,text:string,description:string,visible_text:string>, _corrupt_record string"
)


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Regions of page files (a JSON array each) with volume and page_id from the path; unreadable files give no row."""
    frame = spark.read.schema(REGION).json(path, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")
    file = F.col("_metadata.file_path")
    return frame.select("*", F.regexp_extract(file, r"_(\d+)_[^/]*/regions/", 1).try_cast("int").alias("volume"), F.regexp_extract(file, r"([^/]+)\.json$", 1).alias("page_id")).filter("_corrupt_record is null and type is not null").drop("_corrupt_record")


# What a region's type makes of it.
BODY = ("Paragraph", "List", "Footnote", "Table")
MULTIMODAL = ("Image", "Object", "Graphic", "Marginalia", "Insert")


def classify(regions: DataFrame) -> DataFrame:
    """Body text and multimodal rows; page numbers are dropped, order is 99 where there is none."""
    ok = (F.col("transcription.status") == "success") & ~F.coalesce("transcription.skipped", F.lit(False))
    return regions.filter("type <> 'PageNumber'").select(
        "*", F.col("type").isin(*BODY).alias("is_body"), F.col("type").isin(*MULTIMODAL).alias("is_multimodal"), F.coalesce("reading_order", F.lit(99)).alias("at"),
        F.when(ok, F.trim("transcription.text")).otherwise("").alias("text"), F.when(ok, F.trim("transcription.description")).otherwise("").alias("description"),
    )


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of a Markdown catalogue: keys and values of their comment, the text after it, and the volume of the heading before."""
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"(?m)^(?=<!-- mm |# )")).alias("pos", "block"))
    w = Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.nullif(F.regexp_extract("block", r"^# .*?(\d+)", 1), F.lit("")).try_cast("int")
    rows = lines.withColumn("volume", F.last(heading, ignorenulls=True).over(w)).filter(F.col("block").startswith("<!-- mm "))
    pairs = F.str_to_map(F.trim(F.regexp_extract("block", r"^<!-- mm (.*?)-->", 1)), F.lit(r" +(?=[a-z_]+=)"), F.lit("="))
    return rows.select("file", "pos", "volume", pairs.alias("fields"), F.trim(F.regexp_replace("block", r"(?s)^<!-- mm .*?-->", "")).alias("body"))


def read_geonames(spark: SparkSession, path: str, classes: tuple[str, ...] = ("P", "H", "T", "V", "L", "A", "S")) -> DataFrame:
    """Gazetteer dump lines of at least 15 cells, a row for each distinct folded name."""
    from pageloom.functions.text import fold_gazetteer

    cells = spark.read.text(path).select(F.split("value", "\t").alias("c")).filter("size(c) >= 15")
    cell = lambda i: F.try_element_at("c", F.lit(i + 1))
    rows = cells.filter(cell(6).isin(*classes)).select(
        cell(0).try_cast("long").alias("id"), cell(1).alias("name"), cell(4).try_cast("double").alias("lat"), cell(5).try_cast("double").alias("lon"), cell(6).alias("fclass"), cell(7).alias("fcode"),
        cell(8).alias("cc"), cell(10).alias("admin1"), F.coalesce(cell(14).try_cast("long"), F.lit(0)).alias("population"),
        F.array_distinct(F.transform(F.filter(F.concat(F.array(cell(1), cell(2)), F.split(cell(3), ",")), lambda x: (x != "") & (F.length(x) < 60)), fold_gazetteer)).alias("keys"),
    )
    return rows.select("*", F.explode("keys").alias("key")).drop("keys").withColumn("is_primary", F.col("key") == fold_gazetteer(F.col("name")))


def append_cache(cache: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The cache with new answers; failures (null) are not kept, empty answers are, and what was there stays."""
    add = new.filter("value is not null").dropDuplicates([key]).join(cache.select(key), key, "left_anti")
    return cache.unionByName(add.select(cache.columns))
