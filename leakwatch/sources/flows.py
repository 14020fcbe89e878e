"""Flow tables from CSV files, and labels taken from directory names."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from leakwatch.functions import fixed

TEXT_COLUMNS = {"Label", "Source IP", "Destination IP", "Timestamp", "Flow ID", "Flow Key", "Scenario"}


def clean_names(names):
    """Trimmed header names with their positions; later duplicates are dropped."""
    seen, kept = set(), []
    for position, name in enumerate(n.strip() for n in names):
        if name not in seen:
            seen.add(name)
            kept.append((position, name))
    return kept


def read_flow_file(spark, path, tag):
    """One CSV file (or folder of them) with an untidy header; None if it is missing.

    Only the header line is read to plan. All columns but the text ones are
    parsed as doubles; what is not a number becomes null.
    """
    try:
        header = spark.read.option("header", False).csv(path).first()
    except AnalysisException:
        return None
    if header is None:
        return None
    kept = clean_names([str(v) for v in header])
    by_position = [f"_c{i}" for i in range(len(header))]
    schema = ", ".join(f"`{c}` STRING" for c in by_position)
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
    cells = []
    for position, name in kept:
        cell = F.col(by_position[position])
        cells.append((cell if name in TEXT_COLUMNS else cell.try_cast("double")).alias(name))
    return rows.select(*cells, F.lit(tag).alias("_source_file"))


def load_flows(spark, files):
    """Union of the named files (tag -> path) that exist; columns are matched by name."""
    frames = [read_flow_file(spark, path, tag) for tag, path in files.items()]
    frames = [f for f in frames if f is not None]
    if not frames:
        raise FileNotFoundError("no flow file found")
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged


def default_files(folder):
    return {tag: f"{folder}/{name}" for tag, name in fixed.FLOW_FILES.items()}


def scenario_of_path(path):
    """Name of the directory that holds the file (`name` or `key=name`)."""
    return F.regexp_extract(path, r"/(?:[A-Za-z_]+=)?([^/=]+)/[^/]+$", 1)


def with_scenario(frame, path):
    """Scenario and its label from each row's file path; unknown scenarios are left out."""
    labels = F.create_map(*[F.lit(x) for k, v in fixed.SCENARIOS.items() for x in (k, v[0])])
    return (
        frame.withColumn("Scenario", scenario_of_path(path))
        .filter(F.col("Scenario").isin(*fixed.SCENARIOS))
        .withColumn("Label", F.element_at(labels, F.col("Scenario")))
    )


def read_scenarios(spark, root, schema, fmt="parquet"):
    """Record files below one directory per scenario."""
    rows = (
        spark.read.schema(schema).format(fmt).option("recursiveFileLookup", True).load(root)
        .select("*", F.col("_metadata.file_path").alias("_path"))
    )
    return with_scenario(rows, F.col("_path")).drop("_path")


def write_scenarios(flows, path):
    """Flow features split by scenario."""
    flows.write.mode("overwrite").partitionBy("Scenario").parquet(path)
