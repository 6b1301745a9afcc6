"""Sources: history dumps (TSV, bz2), logging dumps (XML, gz), group rights (JSON), and the partitioned warehouse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridia.functions import fields

#: The columns of a history dump, in the order of the file.
HISTORY = (
    "wiki_db", "event_log_id", "event_entity", "event_type", "event_timestamp", "event_comment", "event_user_id", "event_user_central_id", "event_user_text_historical", "event_user_text",
    "event_user_blocks_historical", "event_user_blocks", "event_user_groups_historical", "event_user_groups", "event_user_is_bot_by_historical", "event_user_is_bot_by", "event_user_is_created_by_self",
    "event_user_is_created_by_system", "event_user_is_created_by_peer", "event_user_is_anonymous", "event_user_is_temporary", "event_user_is_permanent", "event_user_is_cross_wiki",
    "event_user_registration_timestamp", "event_user_creation_timestamp", "event_user_first_edit_timestamp", "event_user_revision_count", "event_user_seconds_since_previous_revision",
    "page_id", "page_title_historical", "page_title", "page_namespace_historical", "page_namespace_is_content_historical", "page_namespace", "page_namespace_is_content", "page_is_redirect",
    "page_is_deleted", "page_creation_timestamp", "page_first_edit_timestamp", "page_revision_count", "page_seconds_since_previous_revision", "user_id", "user_central_id", "user_text_historical",
    "user_text", "user_blocks_historical", "user_blocks", "user_groups_historical", "user_groups", "user_is_bot_by_historical", "user_is_bot_by", "user_is_created_by_self", "user_is_created_by_system",
    "user_is_created_by_peer", "user_is_anonymous", "user_is_temporary", "user_is_permanent", "user_registration_timestamp", "user_creation_timestamp", "user_first_edit_timestamp",
    "revision_id", "revision_parent_id", "revision_minor_edit", "revision_deleted_parts", "revision_deleted_parts_are_suppressed", "revision_text_bytes", "revision_text_bytes_diff",
    "revision_text_sha1", "revision_content_model", "revision_content_format", "revision_is_deleted_by_page_deletion", "revision_deleted_by_page_deletion_timestamp", "revision_is_identity_reverted",
    "revision_first_identity_reverting_revision_id", "revision_seconds_to_identity_revert", "revision_is_identity_revert", "revision_is_from_before_page_creation", "revision_tags",
)


def _schema(text: str) -> T.StructType:
    kinds = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType()}
    return T.StructType([T.StructField(c.split()[0], kinds[c.split()[1]]) for c in text.split(", ")])


#: The columns of the warehouse and their kinds.
WAREHOUSE = _schema(
    "wiki_db string, event_timestamp string, event_user_id long, event_user_text string, event_user_is_bot_by string, event_user_is_anonymous boolean, event_user_is_temporary boolean, "
    "event_user_registration_timestamp string, event_user_first_edit_timestamp string, page_id long, page_title string, page_namespace int, page_namespace_is_content string, page_is_redirect string, "
    "revision_id long, revision_parent_id long, revision_minor_edit boolean, revision_text_bytes long, revision_text_bytes_diff long, revision_is_identity_reverted boolean, "
    "revision_is_identity_revert string, revision_tags string, year_month_key int, user_type string, is_reverted boolean, is_minor boolean, year int, year_month string"
)
ANALYTICAL = ("year_month", "year", "year_month_key", "user_type", "event_user_id", "page_namespace", "revision_id", "revision_text_bytes_diff", "is_reverted", "is_minor")
NUMBERS = ("event_user_id", "page_id", "page_namespace", "revision_id", "revision_parent_id", "revision_text_bytes", "revision_text_bytes_diff")
FLAGS = ("event_user_is_anonymous", "event_user_is_temporary", "revision_minor_edit", "revision_is_identity_reverted")
LOG_SCHEMA = _schema("id long, timestamp string, type string, logtitle string, params string").add("contributor", _schema("id long, username string"))
EMPTY_ITEMS, EMPTY_BYTES = 10_000, 1 << 20


def read_history(spark: SparkSession, path: str | list[str], columns: tuple[str, ...] = HISTORY) -> DataFrame:
    """A dump's rows, all text: tabs, no header, no quotes, empty fields null. bz2 is split by Spark, and columns that nobody reads are not parsed."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, sep="\t", quote="", nullValue="", header=False, schema=schema)


def ingest(history: DataFrame) -> DataFrame:
    """Created revisions as ``WAREHOUSE`` has them. A timestamp without a year or month is an error. Columns that the dump lacks are null."""
    rows = history.where((F.col("event_entity") == "revision") & (F.col("event_type") == "create"))
    rows = rows.withColumns({f.name: F.lit(None).cast("string") for f in WAREHOUSE[:22] if f.name not in history.columns})
    rows = rows.withColumns({c: F.col(c).try_cast("int" if c == "page_namespace" else "long") for c in NUMBERS}).withColumns({c: fields.flag(F.col(c)) for c in FLAGS})
    ts = F.col("event_timestamp")
    bad = F.raise_error(F.concat(F.lit("bad event_timestamp: "), F.coalesce(ts, F.lit("null"))))
    rows = rows.withColumn("year", F.coalesce(fields.year(ts), bad.cast("int"))).withColumn("year_month_key", F.coalesce(fields.year_month_key(ts), bad.cast("int")))
    rows = rows.withColumn("year_month", fields.year_month(ts)).withColumn("user_type", fields.user_type(F.col("event_user_is_bot_by"), F.col("event_user_is_anonymous"), F.col("event_user_is_temporary")))
    return rows.withColumns({"is_reverted": F.col("revision_is_identity_reverted"), "is_minor": F.col("revision_minor_edit")}).select(*WAREHOUSE.names)


def _derived(rows: DataFrame) -> dict[str, Column]:
    """What a frame's derived columns are: its own, or by its schema from raw ones, whose flags may be booleans or texts."""
    kinds, ts = dict(rows.dtypes), F.col("event_timestamp")
    raw = lambda c: fields.flag(F.col(c), kinds.get(c) == "boolean")
    made = {
        "year_month": lambda: fields.year_month(ts), "year": lambda: fields.year(ts), "year_month_key": lambda: fields.year_month_key(ts), "is_reverted": lambda: raw("revision_is_identity_reverted"), "is_minor": lambda: raw("revision_minor_edit"),
        "user_type": lambda: fields.user_type(F.col("event_user_is_bot_by"), raw("event_user_is_anonymous"), raw("event_user_is_temporary")),
    }
    return {c: F.col(c) if c in kinds else make() for c, make in made.items()}


def _created(rows: DataFrame) -> DataFrame:
    return rows.where((F.col("event_entity") == "revision") & (F.col("event_type") == "create")) if {"event_entity", "event_type"} <= set(rows.columns) else rows


def analytical(rows: DataFrame) -> DataFrame:
    """The analytical columns; what an older frame lacks is derived from its raw columns."""
    made = _derived(rows)
    return _created(rows).select(*[made.get(c, F.col(c)).alias(c) for c in ANALYTICAL])


def revisions(rows: DataFrame) -> DataFrame:
    """A warehouse, or an older flat frame, as the relation ``revisions`` of the metrics. Pages are null where the frame has none."""
    made, page = _derived(rows), lambda c, kind: F.col(c) if c in rows.columns else F.lit(None).cast(kind)
    return _created(rows).select("event_timestamp", "event_user_id", made["user_type"].alias("user_type"), page("page_id", "long").alias("page_id"), page("page_title", "string").alias("page_title"), "page_namespace", "revision_id", F.col("revision_text_bytes_diff").alias("diff"), made["is_reverted"].alias("reverted"), made["is_minor"].alias("minor"))


def patrol_revisions(rows: DataFrame) -> DataFrame:
    """A warehouse as the relation ``patrol_revisions``: plain timestamps, and the patrol's own view of who is a bot. A month's row without a valid time is an error there; null ones are skipped."""
    ts = fields.normal_timestamp(F.col("event_timestamp"))
    sound = F.when(fields.epoch(ts).isNotNull(), ts).otherwise(F.raise_error(F.concat(F.lit("invalid revision timestamp: "), F.col("event_timestamp"))))
    kind = fields.user_type(F.col("event_user_is_bot_by"), F.col("event_user_is_anonymous"), F.col("event_user_is_temporary"), patrol=True)
    return rows.where("event_timestamp IS NOT NULL").select("revision_id", sound.alias("event_timestamp"), "event_user_text", "page_namespace", kind.alias("user_type"))


def log_relations(patrol: DataFrame, rights: DataFrame) -> dict[str, DataFrame]:
    """Patrol and rights events as the metrics' relations of these names."""
    return {
        "patrol_events": patrol.where(fields.year_month_key(F.col("timestamp")).isNotNull()).select("log_id", F.col("timestamp").alias("event_timestamp"), F.col("user").alias("patroller"), "current_revision_id", "prev_revision_id"),
        "rights_events": rights.select(F.col("timestamp").alias("event_timestamp"), "target_user", "old_groups", "new_groups"),
    }


def write_warehouse(rows: DataFrame, path: str) -> None:
    """Parquet by year and month; a month is replaced whole when it is written again. A month is as many tasks as its size asks for."""
    spread = rows.hint("rebalance", "year", "year_month")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("year", "year_month").parquet(path)


def read_warehouse(spark: SparkSession, path: str) -> DataFrame:
    """The warehouse; months are texts, and filters on them prune folders."""
    return spark.read.schema(WAREHOUSE).parquet(path)


def read_analytical(spark: SparkSession, path: str) -> DataFrame:
    """A folder that may hold both layouts: the partitioned files, if there are any, else the flat ones."""
    java = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    parted = [str(s.getPath()) for s in java.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(java) if s.isDirectory() and s.getPath().getName().startswith("year=")]
    return spark.read.schema(WAREHOUSE).option("basePath", path).parquet(*parted) if parted else spark.read.parquet(path)


def read_log(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """Log items of an XML dump, gzip in one or several members; malformed XML is an error. White space counts: a list of groups may begin with an empty line. ``most``: a sample of so many items."""
    log = spark.read.xml(path, rowTag="logitem", ignoreNamespace=True, ignoreSurroundingSpaces=False, mode="FAILFAST", schema=LOG_SCHEMA)
    return log.limit(most) if most is not None else log


def patrol_events(log: DataFrame) -> DataFrame:
    rows = log.where("type = 'patrol'").withColumn("p", fields.patrol_params(F.col("params")))
    return rows.select(F.col("id").alias("log_id"), fields.normal_timestamp(F.col("timestamp")).alias("timestamp"), F.col("contributor.username").alias("user"), F.col("contributor.id").alias("user_id"), F.col("logtitle").alias("page_title"), "p.*")


def rights_events(log: DataFrame) -> DataFrame:
    rows = log.where("type = 'rights'").withColumn("p", fields.rights_params(F.col("params")))
    return rows.select(fields.normal_timestamp(F.col("timestamp")).alias("timestamp"), fields.title_user(F.col("logtitle")).alias("target_user"), "p.*")


def check_log(log: DataFrame, size: int = 0) -> tuple[int, int]:
    """Items, and patrol or rights entries among them. A substantial log, by items or by its file's bytes, without such an entry is an error."""
    n, used = log.agg(F.count("*"), F.count_if(F.col("type").isin("patrol", "rights"))).first()
    if (n >= EMPTY_ITEMS or size >= EMPTY_BYTES) and not used:
        raise ValueError(f"{n} log items in {size} bytes, none of them patrol or rights")
    return n, used


def autopatrol_groups(spark: SparkSession, path: str) -> DataFrame:
    """(name): groups that hold the right ``autopatrol``, of a site's JSON."""
    site = spark.read.json(path, multiLine=True, schema="query struct<usergroups:array<struct<name:string,rights:array<string>>>>")
    return site.select(F.explode("query.usergroups").alias("g")).where(F.array_contains("g.rights", "autopatrol")).select("g.name")


def api_domain(wiki: str) -> str | None:
    """The host of a wiki's site: nlwiki is nl.wikipedia.org; other names have none."""
    return f"{wiki.removesuffix('wiki')}.wikipedia.org" if wiki.endswith("wiki") and wiki != "wiki" else None


def merge(spark: SparkSession, paths: list[str], wikis: list[str] | None = None) -> DataFrame:
    """Datasets of several wikis as one scan, in order of their paths, with the first one's schema; only rows of ``wikis``, if given."""
    paths = sorted(paths)
    if not paths:
        raise ValueError("nothing to merge")
    merged = spark.read.schema(spark.read.parquet(paths[0]).schema).parquet(*paths)
    return merged.where(F.col("wiki").isin(wikis)) if wikis is not None else merged


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).option("emptyValue", "").option("nullValue", "").option("escape", '"').csv(path)
