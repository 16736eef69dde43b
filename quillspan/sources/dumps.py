"""Reference dumps: compound tables (gzipped TSV) and the taxonomy (tar of .dmp files)."""

from __future__ import annotations

import io
import tarfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hierarchy import ancestors
from ..operators.linking import first_by
from ..session import shared_dir, ship

TAXONOMY = {"nodes": "nodes.dmp", "names": "names.dmp", "merged": "merged.dmp"}


#: Columns of each compound dump, and those that a row must have.
DUMPS = {
    "smiles": ("cid bigint, smiles string", ("cid", "smiles")),
    "inchikeys": ("cid bigint, inchi string, inchikey string", ("cid", "inchikey")),
    "synonyms": ("cid bigint, synonym string", ("cid", "synonym")),
}


def _tsv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """All rows with row_idx (by file name, and by place within a file), line (null unless the row is malformed) and reason (why a
    row is no good, else null).  A gzip file is one task, others are read in blocks."""
    schema, needed = DUMPS[kind]
    options = {"sep": "\t", "quote": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "line"}
    rows = spark.read.schema(f"{schema}, line string").options(**options).csv(path)
    files = {name: i for i, name in enumerate(sorted(rows.inputFiles()))}  # some files: dumps are single or few
    number = F.lit(0).cast("long")
    if len(files) > 1:
        number = F.try_element_at(F.create_map(*[F.lit(x) for k, v in files.items() for x in (k, v)]), F.input_file_name()).cast("long")
    # a record's number in its task, below the block of the file that the task reads
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    start = F.shiftright(F.col("_metadata.file_block_start"), 20)
    rows = rows.withColumn("row_idx", F.shiftleft(F.coalesce(number, F.lit(0).cast("long")), 54) + F.shiftleft(start, 33) + place)
    missing = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in needed])
    return rows.withColumn("reason", F.when(F.col("line").isNotNull(), "malformed").otherwise(missing))


def rejected_rows(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The rows of a dump (smiles, inchikeys or synonyms) that are left out: row_idx, reason, and line: the malformed line as it is, or
    the columns of a row that lacks a value it must have.  Rows read are those that are kept, these, and repeats of a key."""
    rows = _tsv(spark, path, kind)
    columns = [c for c in rows.columns if c not in ("line", "row_idx", "reason")]
    text = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return rows.where("reason IS NOT NULL").select("row_idx", "reason", F.coalesce("line", text).alias("line"))


def _good(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return _tsv(spark, path, kind).where("reason IS NULL").drop("line", "reason")


def read_smiles(spark: SparkSession, path: str) -> DataFrame:
    """cid and smiles; the first row of each cid.  For rows without both see rejected_rows."""
    return first_by(_good(spark, path, "smiles"), "cid", "row_idx").select("cid", "smiles")


def read_inchikeys(spark: SparkSession, path: str) -> DataFrame:
    """cid and inchikey, from the first and third column."""
    return first_by(_good(spark, path, "inchikeys").drop("inchi"), "cid", "row_idx").select("cid", "inchikey")


def read_synonyms(spark: SparkSession, path: str) -> DataFrame:
    """row_idx, cid and synonym."""
    return _good(spark, path, "synonyms").select("row_idx", "cid", "synonym")


def _untar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wanted = {v: k for k, v in TAXONOMY.items()}
    for batch in batches:
        for raw in batch.column("content"):
            with tarfile.open(fileobj=io.BytesIO(raw.as_buffer().to_pybytes()), mode="r:*") as tar:
                for member in tar:
                    kind = wanted.get(member.name.rpartition("/")[2])
                    file = tar.extractfile(member) if kind else None
                    if file is None:
                        continue
                    lines, at = [], 0
                    for line in io.TextIOWrapper(file, "utf-8"):
                        lines.append(line.rstrip("\n"))
                        if len(lines) == 50_000:
                            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(lines)), pa.array(range(at, at + len(lines)), pa.int64()), pa.array(lines)], ["kind", "row_idx", "line"])
                            at += len(lines)
                            lines = []
                    yield pa.RecordBatch.from_arrays([pa.array([kind] * len(lines), pa.string()), pa.array(range(at, at + len(lines)), pa.int64()), pa.array(lines, pa.string())], ["kind", "row_idx", "line"])


def unpack_taxonomy(spark: SparkSession, archive: str, folder: str, lines_each: int = 200_000) -> None:
    """Writes the lines of an archive's tables to a folder of small Parquet files, by table.

    A gzip stream can only be read from its start, so this one step is one task; it holds some lines at a time, and all later
    work reads the files it wrote in as many tasks as there are.
    """
    ship(spark)
    lines = spark.read.format("binaryFile").load(archive).select("content").mapInArrow(_untar, "kind string, row_idx bigint, line string")
    lines.write.mode("overwrite").option("maxRecordsPerFile", lines_each).partitionBy("kind").parquet(folder)


def taxonomy_lines(spark: SparkSession, path: str) -> DataFrame:
    """kind (nodes, names, merged), row_idx and line, from a taxonomy archive, which is unpacked to the shared folder first, or
    from a folder of its .dmp files."""
    if path.rstrip("/").endswith((".tar.gz", ".tgz", ".tar")):
        folder = f"{shared_dir(spark)}/taxonomy-{uuid.uuid4().hex}"
        unpack_taxonomy(spark, path, folder)
        return spark.read.schema("row_idx bigint, line string, kind string").parquet(folder)
    lines = spark.read.text(f"{path}/*.dmp").select("value", F.regexp_extract("_metadata.file_name", r"(\w+)\.dmp", 1).alias("kind"), F.monotonically_increasing_id().alias("row_idx"))
    return lines.select("kind", "row_idx", F.col("value").alias("line"))


def read_taxonomy(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """nodes (tax_id, parent_tax_id, rank), names (row_idx, tax_id, name, name_class), merged (old_tax_id, new_tax_id)."""
    fields = F.split(F.regexp_replace("line", r"\t\|\s*$", ""), r"\t\|\t")
    rows = taxonomy_lines(spark, path).withColumn("f", F.transform(fields, lambda x: F.trim(x)))

    def field(i: int, kind: str = "string"):
        return F.get("f", F.lit(i)).try_cast(kind)

    nodes = rows.where("kind = 'nodes'").select(field(0, "int").alias("tax_id"), field(1, "int").alias("parent_tax_id"), field(2).alias("rank"), "row_idx")
    names = rows.where("kind = 'names'").select("row_idx", field(0, "int").alias("tax_id"), field(1).alias("name"), field(3).alias("name_class"))
    merged = rows.where("kind = 'merged'").select(field(0, "int").alias("old_tax_id"), field(1, "int").alias("new_tax_id"), "row_idx")
    return {
        "nodes": first_by(nodes.where("tax_id IS NOT NULL"), "tax_id", "row_idx").select("tax_id", "parent_tax_id", "rank"),
        "names": names.where("tax_id IS NOT NULL AND name IS NOT NULL"),
        "merged": first_by(merged.where("old_tax_id IS NOT NULL"), "old_tax_id", "row_idx").select("old_tax_id", "new_tax_id"),
    }


def lineage(nodes: DataFrame) -> DataFrame:
    """tax_id, ancestor and depth for every ancestor of a node, however deep the tree is (see hierarchy.ancestors)."""
    return ancestors(nodes, "tax_id", "parent_tax_id")
