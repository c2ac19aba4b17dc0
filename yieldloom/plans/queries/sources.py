"""Queries over the text sources and the entity join."""

import uuid

from pyspark.sql import functions as F

from yieldloom.operators.profile import feature_action_summary, feature_catalog, overview
from yieldloom.operators.separation import failure_relationship
from yieldloom.plans.export import as_document
from yieldloom.plans.registry import CATALOG, LOTS, RANKING, SENSORS, query
from yieldloom.recipes import SENSORS as N_SENSORS
from yieldloom.recipes import lot_entities, sensor_entities
from yieldloom.sources.results import COMPARISON_SCHEMA, read_comparison, write_comparison
from yieldloom.sources.tables import canonical, chronological, load_table, measurement_schema, replace_table, scan
from yieldloom.sources.text import numbered_lines, parse_labels, parse_measurements, read_measurements
from yieldloom.sources.workspace import new_folder, settled

FEATURES = [f"feature_{i:03d}" for i in range(1, N_SENSORS + 1)]
# every fifth reading of the second sensor is written as missing
CELLS = ", ".join(
    f"CASE WHEN {i} = 1 AND vec_id % 5 = 0 THEN NULL ELSE CAST(embedding[{i + 1}] AS DOUBLE) END AS {name}"
    for i, name in enumerate(FEATURES)
)


def measurement_lines(sensors):
    """Sensor rows as text lines."""
    cells = [F.col(c).cast("string") for c in FEATURES]
    cells[1] = F.when(F.col("entity_id") % 5 == 0, "NaN").otherwise(cells[1])
    return sensors.select(F.col("entity_id").alias("row_number"), F.concat_ws("  ", *cells).alias("value"))


@query("measurement_lines", f"SELECT vec_id AS entity_id, {CELLS} FROM embeddings", " ".join(FEATURES))
def _(spark, sf_dir):
    return parse_measurements(measurement_lines(sensor_entities(spark, sf_dir)), N_SENSORS)


@query("measurement_file", f"SELECT vec_id + 1 AS entity_id, {CELLS} FROM embeddings", " ".join(FEATURES))
def _(spark, sf_dir):
    folder = new_folder(spark, "measurements")
    lines = measurement_lines(sensor_entities(spark, sf_dir)).orderBy("row_number")
    # tabs around some lines, and blank lines of tabs between others
    edge = F.when(F.col("row_number") % 3 == 0, "\t ").otherwise("")
    after = F.when(F.col("row_number") % 7 == 0, " \t\n\t").otherwise("")
    lines.select(F.concat(edge, "value", edge, after).alias("value")).write.text(folder)
    return read_measurements(spark, folder)


@query(
    "numbered_document_lines",
    """SELECT count(*) AS n_lines, CAST(min(rn) AS BIGINT) AS first_number, CAST(max(rn) AS BIGINT) AS last_number, count(DISTINCT rn) AS n_numbers
       FROM (SELECT row_number() OVER () AS rn FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE trim(regexp_replace(line, '[\\s\\x0B]', ' ', 'g')) <> '')""",
)
def _(spark, sf_dir):
    folder = new_folder(spark, "lines")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # several files, of about one split of the table each
    files = max(4, documents.rdd.getNumPartitions())
    documents.select(F.regexp_replace("text", "\r", " ").alias("value")).repartition(files).write.text(folder)
    numbers = numbered_lines(spark, folder)
    return numbers.agg(
        F.count("*").alias("n_lines"),
        F.min("row_number").alias("first_number"),
        F.max("row_number").alias("last_number"),
        F.count_distinct("row_number").alias("n_numbers"),
    )


@query(
    "label_lines",
    f"WITH {SENSORS} SELECT entity_id, yield_label, test_timestamp, CASE WHEN yield_label = 1 THEN 'fail' ELSE 'pass' END AS pass_fail FROM sens",
)
def _(spark, sf_dir):
    sensors = sensor_entities(spark, sf_dir)
    stamp = F.date_format("test_timestamp", "dd/MM/yyyy HH:mm:ss")
    quoted = F.concat(F.col("yield_label").cast("string"), F.lit(' "'), stamp, F.lit('"'))
    bare = F.concat_ws(" ", F.col("yield_label").cast("string"), stamp)
    line = F.when(F.col("entity_id") % 3 == 0, bare).otherwise(quoted)
    line = F.when(F.col("entity_id") % 4 == 0, F.concat(F.lit("\t"), line, F.lit(" \t"))).otherwise(line)
    return parse_labels(sensors.select(F.col("entity_id").alias("row_number"), line.alias("value")))


@query("canonical_entities", f"WITH {LOTS} SELECT * FROM lots", " ".join(f"feature_{i:03d}" for i in range(1, 8)))
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    measured = lots.select("entity_id", *[f"feature_{i:03d}" for i in range(1, 8)])
    labels = lots.select("entity_id", "test_timestamp", "yield_label", "pass_fail")
    return chronological(canonical(measured, labels))


@query("json_report")
def _(spark, sf_dir):
    lots = lot_entities(spark, sf_dir)
    catalog = feature_catalog(lots)
    parts = {
        "overview": as_document(overview(lots), single=True),
        "actions": as_document(feature_action_summary(catalog)),
        "relationship": as_document(failure_relationship(lots)),
    }
    out = None
    for name, part in parts.items():
        part = part.select(F.lit(name).alias("section"), "json")
        out = part if out is None else out.unionByName(part)
    return out


# The report tables as JSON text, read back: what a reader of the export sees.
ACTION_SQL = f"""WITH {CATALOG} SELECT recommended_action, count(*) AS feature_count FROM cat GROUP BY 1"""


@query("json_actions_read_back", ACTION_SQL)
def _(spark, sf_dir):
    actions = feature_action_summary(feature_catalog(lot_entities(spark, sf_dir))).select("recommended_action", "feature_count")
    kind = "array<struct<recommended_action:string,feature_count:long>>"
    return as_document(actions).select(F.inline(F.from_json("json", kind)))


@query(
    "json_relationship_read_back",
    f"WITH {RANKING} SELECT feature_name, effect_size, valid_pass_count, valid_fail_count FROM rel",
    "effect_size",
)
def _(spark, sf_dir):
    relation = failure_relationship(lot_entities(spark, sf_dir)).select("feature_name", "effect_size", "valid_pass_count", "valid_fail_count")
    kind = "array<struct<feature_name:string,effect_size:double,valid_pass_count:long,valid_fail_count:long>>"
    return as_document(relation).select(F.inline(F.from_json("json", kind)))


COMPARED = [f.name for f in COMPARISON_SCHEMA if f.name not in ("model", "feature_set", "evaluation_protocol", "n_features")]


@query(
    "comparison_read_back",
    "SELECT l_returnflag AS model, l_linestatus AS feature_set, 'by line' AS evaluation_protocol, CAST(count(DISTINCT l_linenumber) AS INTEGER) AS n_features, "
    + ", ".join("count(*) AS " + c if c.startswith("captured") else "avg(l_discount) AS " + c for c in COMPARED)
    + " FROM lineitem GROUP BY 1, 2",
    " ".join(c for c in COMPARED if not c.startswith("captured")),
)
def _(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy(F.col("l_returnflag").alias("model"), F.col("l_linestatus").alias("feature_set"))
    columns = [F.count("*").alias(c) if c.startswith("captured") else F.avg("l_discount").alias(c) for c in COMPARED]
    table = lines.agg(F.lit("by line").alias("evaluation_protocol"), F.count_distinct("l_linenumber").cast("int").alias("n_features"), *columns)
    folder = new_folder(spark, "comparison")
    write_comparison(table.select(*COMPARISON_SCHEMA.names), folder)
    return read_comparison(spark, folder)


@query("scanned_lots", f"WITH {LOTS} SELECT * FROM lots", " ".join(f"feature_{i:03d}" for i in range(1, 8)))
def _(spark, sf_dir):
    """The lots written as a Parquet table and scanned."""
    folder = new_folder(spark, "lots")
    lot_entities(spark, sf_dir).write.parquet(folder)
    return scan(spark, path=folder)


def _table_name(name):
    return f"{name}_{uuid.uuid4().hex}"


@query(
    "replaced_table",
    """SELECT 'kept by a failed write' AS step, count(*) AS n, CAST(sum(s_suppkey) AS BIGINT) AS keys FROM supplier
       UNION ALL SELECT 'replaced', count(*), CAST(sum(p_partkey) AS BIGINT) FROM part
       UNION ALL SELECT 'replaced by its own rows', count(*), CAST(sum(p_partkey) AS BIGINT) FROM part WHERE p_partkey % 2 = 0""",
)
def _(spark, sf_dir):
    """What a table holds after a write that fails, after one that succeeds, and after one that reads the table itself."""
    name = _table_name("replaced")
    read = lambda table, key: spark.read.parquet(f"{sf_dir}/{table}.parquet").select(F.col(key).cast("long").alias("key"))
    steps = []

    def look(step):
        found = spark.table(name).agg(F.count("*").alias("n"), F.sum("key").alias("keys"))
        steps.append(settled(found.select(F.lit(step).alias("step"), "n", "keys")))

    replace_table(read("supplier", "s_suppkey"), name)
    broken = read("part", "p_partkey").withColumn("key", F.when(F.col("key") > 0, F.raise_error(F.lit("unreadable")).cast("long")).otherwise(F.col("key")))
    try:
        replace_table(broken, name)
    except Exception as failure:
        if "unreadable" not in str(failure):
            raise
    look("kept by a failed write")
    replace_table(read("part", "p_partkey"), name)
    look("replaced")
    replace_table(spark.table(name).where("key % 2 = 0"), name)
    look("replaced by its own rows")
    spark.sql(f"DROP TABLE {name}")
    return steps[0].unionByName(steps[1]).unionByName(steps[2])


@query(
    "ingestion_log",
    """SELECT 'suppliers' AS table_name, 'first' AS load_id, count(*) AS rows_loaded, 1::BIGINT AS entries FROM supplier
       UNION ALL SELECT 'suppliers', 'second', count(*), 1 FROM supplier WHERE s_suppkey % 3 = 0
       UNION ALL SELECT 'parts', 'first', count(*), 1 FROM part UNION ALL SELECT 'parts', NULL, count(*), 2 FROM part""",
)
def _(spark, sf_dir):
    """The log after loads of which some are repeated: those with an id count once, those without every time."""
    log, tables = _table_name("log"), {t: _table_name(t) for t in ("suppliers", "parts")}
    suppliers, parts = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("supplier", "part"))
    loads = [("suppliers", suppliers, "first"), ("parts", parts, "first"), ("suppliers", suppliers, "first"), ("parts", parts, None)]
    loads += [("suppliers", suppliers.where("s_suppkey % 3 = 0"), "second"), ("suppliers", suppliers, "second"), ("parts", parts, None)]
    for table, rows, load_id in loads:
        load_table(rows, tables[table], table, sf_dir, log, load_id)
    entries = settled(spark.table(log).groupBy("table_name", "load_id", "rows_loaded").agg(F.count("*").alias("entries")))
    for name in (log, *tables.values()):
        spark.sql(f"DROP TABLE {name}")
    return entries


@query(
    "typed_measurements",
    f"SELECT column_name AS name, column_type AS type, n FROM (DESCRIBE SELECT CAST(0 AS BIGINT) AS entity_id, {', '.join(f'CAST(0 AS DOUBLE) AS {c}' for c in FEATURES)}), (SELECT count(*) AS n FROM embeddings)",
)
def _(spark, sf_dir):
    """The raw table's declared columns, next to the rows read into it."""
    folder = new_folder(spark, "measurements-typed")
    lines = measurement_lines(sensor_entities(spark, sf_dir)).orderBy("row_number").select("value")
    lines.write.text(folder)
    loaded = read_measurements(spark, folder)
    schema = measurement_schema(N_SENSORS)
    if [(f.name, f.dataType) for f in loaded.schema] != [(f.name, f.dataType) for f in schema]:
        raise ValueError("the loaded columns are not those declared")
    declared = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit({"bigint": "BIGINT", "double": "DOUBLE"}[f.dataType.simpleString()]).alias("type")) for f in schema])
    return loaded.agg(F.count("*").alias("n")).select(F.inline(declared), "n")
