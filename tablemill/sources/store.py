"""Reading, snapshots with manifests, archives and sinks."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablemill.operators.retention import Target, survivors

RUN_ID = "%Y-%m-%dT%H%M%SZ"


def run_id(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime(RUN_ID)


def read_landing(spark: SparkSession, path: str, kind: str | None = None, schema=None) -> DataFrame:
    """Landed raw files; the format follows the path's ending unless given."""
    kind = kind or next((k for k in ("parquet", "orc", "json", "csv") if re.search(rf"\.{k}(\.|$)|/{k}/", path)), "parquet")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.options(header=True).csv(path) if kind == "csv" else reader.format(kind).load(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as there are cores, if it has fewer: a small table in one row group is one
    task else, however much work a row is.  A table of many splits stays as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table by JDBC; ``options`` as Spark's reader takes them (driver, partitionColumn ...)."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def list_tables(spark: SparkSession) -> DataFrame:
    """table_name, column, type, nullable of all tables and views that the session knows."""
    rows = [(t.name, f.name, f.dataType.simpleString(), f.nullable) for t in spark.catalog.listTables() for f in spark.table(t.name if t.isTemporary else f"{'.'.join(t.namespace or [])}.{t.name}".lstrip(".")).schema]
    return spark.createDataFrame(rows, "table_name string, column string, type string, nullable boolean")


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names in a folder that begin with ``prefix``; none if there is no such folder."""
    p, fs = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in names if n.startswith(prefix))


def delete(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.delete(p, True))


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text; readers see the old or the new one, the replacement being one rename."""
    p, fs = _fs(spark, path)
    jvm = spark._jvm
    tmp = p.suffix(f".{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsparkSession.sessionState().newHadoopConf()) if p.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsparkSession.sessionState().newHadoopConf())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(tmp, p, how)


def put_json(spark: SparkSession, path: str, data: dict) -> None:
    put_text(spark, path, json.dumps(data, indent=2, default=str))


def get_json(spark: SparkSession, path: str, default: dict | None = None) -> dict | None:
    if not exists(spark, path):
        return default
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def delete_json(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.delete(p, False))


class Snapshots:
    """Versioned tables under one folder: run_id=<id>/<table>, a manifest for each run, a pointer to the last."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def write(self, run: str, table: str, df: DataFrame) -> dict:
        """Write, read back and compare count and schema before the table counts as written."""
        path = f"{self.root}/run_id={run}/{table}"
        began, told = time.time(), Observation(f"{table}-{uuid.uuid4().hex}")
        df.observe(told, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        back = self.spark.read.parquet(path)
        rows, found = told.get["rows"], back.count()
        if [f.name for f in back.schema] != df.columns:
            raise RuntimeError(f"{path}: columns differ after writing")
        if found != rows:
            raise RuntimeError(f"{path}: {rows} rows written, {found} found")
        return {"table": table, "path": path, "rows": found, "columns": back.columns, "seconds": round(time.time() - began, 3)}

    def finish(self, run: str, table: str, given: str, entry: dict) -> None:
        """Note that a run's table is complete, and from what input."""
        put_json(self.spark, f"{self.root}/run_id={run}/_finished/{table}.json", {"given": given, "entry": entry})

    def finished(self, run: str, table: str, given: str) -> dict | None:
        """The entry of a table that this run completed from the same input, marked as taken over."""
        note = get_json(self.spark, f"{self.root}/run_id={run}/_finished/{table}.json")
        if not note or note["given"] != given or not exists(self.spark, f"{note['entry']['path']}/_SUCCESS"):
            return None
        return note["entry"] | {"resumed": True}

    def truncate(self, run: str, table: str) -> dict:
        """A version of ``table`` without rows, of the same columns."""
        return self.write(run, table, self.read(table).limit(0))

    def publish(self, run: str, tables: list[dict], **extra) -> dict:
        """The run's manifest, then the pointer: readers of the pointer never see a run half written."""
        manifest = {"run_id": run, "created_at": datetime.now(timezone.utc).isoformat(), "tables": tables, **extra}
        put_json(self.spark, f"{self.root}/run_id={run}/manifest.json", manifest)
        put_json(self.spark, f"{self.root}/latest.json", {"run_id": run})
        return manifest

    def latest(self) -> dict | None:
        pointer = get_json(self.spark, f"{self.root}/latest.json")
        return pointer and get_json(self.spark, f"{self.root}/run_id={pointer['run_id']}/manifest.json")

    def read(self, table: str, run: str | None = None) -> DataFrame:
        run = run or (self.latest() or {}).get("run_id")
        return self.spark.read.parquet(f"{self.root}/run_id={run}/{table}")


CONFIRMATION = "DELETE OLD ROWS"


def archive(df: DataFrame, path: str) -> None:
    """Whole rows as gzipped JSON lines."""
    df.write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", "false").json(path)


def clean_up(spark: SparkSession, tables: dict[str, DataFrame], found: list[Target], path: str, run: str, days: int, mode: str = "DRY_RUN", confirm: str = "", id_col: str = "id", shots: Snapshots | None = None) -> dict:
    """Plan, archive and apply retention: DRY_RUN counts, ARCHIVE_ONLY also archives, APPLY also
    writes each table's survivors under ``path``/survivors and, given ``shots``, publishes them there as
    a run of the same tables: they are current from then on, tables without targets as they were.

    APPLY needs the confirmation text, and every archive must hold as many rows as were counted.
    """
    if mode not in ("DRY_RUN", "ARCHIVE_ONLY", "APPLY"):
        raise ValueError(f"unknown mode {mode}")
    if mode == "APPLY" and confirm != CONFIRMATION:
        raise ValueError("APPLY needs the confirmation text")
    manifest = {"run_id": run, "mode": mode, "days": days, "created_at": datetime.now(timezone.utc).isoformat(), "targets": []}
    for t in found:
        count, to = t.rows.count(), None
        if mode != "DRY_RUN":
            to = f"{path}/{run}/{t.name}.jsonl.gz"
            archive(t.rows, to)
            if spark.read.text(to).count() != count:
                raise RuntimeError(f"{t.name}: the archive does not hold {count} rows")
        manifest["targets"].append({"name": t.name, "table_name": t.table, "description": t.description, "rows_archived": count, "archive_path": to})
    if mode == "APPLY":
        for name in {t.table for t in found}:
            left = survivors(tables[name], [t.rows for t in found if t.table == name], id_col)
            left.write.mode("overwrite").parquet(f"{path}/{run}/survivors/{name}")
        if shots is not None:
            kept = {name: spark.read.parquet(f"{path}/{run}/survivors/{name}") for name in {t.table for t in found}}
            rest = {t["table"] for t in (shots.latest() or {"tables": []})["tables"]} - set(kept)
            written = [shots.write(run, name, rows) for name, rows in sorted(kept.items())] + [shots.write(run, name, shots.read(name)) for name in sorted(rest)]
            shots.publish(run, written, cleaned=True)
    if mode != "DRY_RUN":
        put_json(spark, f"{path}/{run}/manifest.json", manifest)
    return manifest


def send_batches(df: DataFrame, send, size: int = 50) -> None:
    """Call ``send(list of dicts)`` on the executors with at most ``size`` rows at a time; a failed
    task is retried by Spark, so ``send`` must be an upsert."""

    def part(rows: Iterator) -> None:
        batch = []
        for r in rows:
            batch.append(r.asDict(recursive=True))
            if len(batch) == size:
                send(batch)
                batch = []
        if batch:
            send(batch)

    df.foreachPartition(part)


def compact(spark: SparkSession, path: str, to: str, file_bytes: int = 256 << 20) -> None:
    """Rewrite a table in files of about ``file_bytes``."""
    p, fs = _fs(spark, path)
    total = fs.getContentSummary(p).getLength()
    rows, files = spark.read.parquet(path), max(1, -(-total // file_bytes))
    # Fewer files need no shuffle; more do.
    (rows.coalesce(files) if files <= len(rows.inputFiles()) else rows.repartition(files)).write.parquet(to)


def table_bytes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    rows = []
    for name, path in paths.items():
        p, fs = _fs(spark, path)
        rows.append((name, fs.getContentSummary(p).getLength()))
    return spark.createDataFrame(rows, "table_name string, bytes long")


def per_term_quota(target: int, terms: int) -> int:
    """Rows wanted of each of ``terms`` search terms for ``target`` rows in all, thrice oversampled."""
    return max(1, int(target * 3.0) // terms)


def union_scans(scans: dict[str, DataFrame]) -> DataFrame:
    """Scans of several search terms as one frame with the term and scan time; missing columns are null."""
    out = None
    for term, df in scans.items():
        one = df.withColumn("search_term_used", F.lit(term))
        if "scraped_at" not in one.columns:
            one = one.withColumn("scraped_at", F.lit(datetime.now(timezone.utc)))  # the same whenever the plan runs
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


class RateLimited(Exception):
    """A source that asks for no more requests."""


#: Errors in a row after which a source is left alone.
MOST_ERRORS = 3


@dataclass
class Scan:
    """What a scan of several terms brought: rows, terms left when the source asked to stop, and failed terms with their errors."""

    rows: DataFrame | None
    left: list[str]
    failed: dict[str, str]


def looks_limited(error: Exception) -> bool:
    """An error that says the source wants no more requests."""
    said = str(error).lower()
    return isinstance(error, RateLimited) or any(x in said for x in ("429", "too many requests", "rate", "blocked", "captcha"))


def scan_terms(terms: list[str], fetch: Callable[[str, int], DataFrame], target: int, most_errors: int = MOST_ERRORS) -> Scan:
    """Terms are fetched one after the other, each for its share of ``target``, until the source asks for a stop
    or fails ``most_errors`` times in a row; what came before stays, and what failed is told."""
    scans: dict[str, DataFrame] = {}
    failed: dict[str, str] = {}
    errors, left = 0, []
    for k, term in enumerate(terms):
        try:
            scans[term] = fetch(term, per_term_quota(target, len(terms))).withColumn("scraped_at", F.lit(datetime.now(timezone.utc)))
            errors = 0
        except Exception as e:
            if looks_limited(e):
                left = terms[k:]
                break
            errors += 1
            failed[term] = str(e)[:500]
            if errors >= most_errors:
                left = terms[k + 1 :]
                break
    return Scan(union_scans(scans) if scans else None, left, failed)


def select_sources(df: DataFrame, platforms: list[str] | None = None, countries: list[str] | None = None) -> DataFrame:
    """Rows of the wanted platforms and countries, whatever their case; None wants all."""
    for column, wanted in (("platform", platforms), ("country", countries)):
        if wanted is not None:
            df = df.filter(F.lower(F.trim(column)).isin([w.strip().lower() for w in wanted]))
    return df


def without_internal(df: DataFrame) -> DataFrame:
    """Without the columns whose name begins with an underscore."""
    return df.select(*(F.col(f"`{c}`") for c in df.columns if not c.startswith("_")))


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, or under a temporary one where that is unset and driver and
    executors are one process."""
    import tempfile

    sc = spark.sparkContext
    shared = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not shared:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="tablemill-")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/tablemill/{name}-{uuid.uuid4().hex}"
