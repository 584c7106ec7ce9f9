"""Step plans, resume decisions and input manifests: small driver-side logic over tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The steps of a run in order, those before the counts first, and the names of workflows and methods.
UPSTREAM = ("sample", "barcode", "cutadapt", "star", "featureCounts", "count")
DOWNSTREAM = ("binSegment", "stardistCellSegment", "cavityFilter", "analysis", "report")
WORKFLOWS = {"st": "ST", "stereo": "ST", "spatial": "ST", "sx": "SX", "sn": "SN", "scrna": "SN"}
METHODS = {"gene_expr": "gene_expr", "gem": "gene_expr", "ssdna": "ssDNA", "dapi": "ssDNA", "he": "HE"}


def lookup(kind: dict[str, str], name: str) -> str:
    found = kind.get(name.strip().lower())
    if found is None:
        raise KeyError(f"unknown name {name!r}; known are {', '.join(sorted(kind))}")
    return found


@dataclass(frozen=True)
class Step:
    name: str
    run: Callable[..., DataFrame] | None = None
    outputs: tuple[str, ...] = field(default_factory=tuple)


def plan(row: dict[str, str], steps: dict[str, Callable] | None = None) -> list[Step]:
    """The ordered steps of a job row: all, from the counts on (pipeline=reanalysis) or the report alone."""
    lookup(WORKFLOWS, row.get("workflow", "st")), lookup(METHODS, row.get("method", "gene_expr"))
    pipeline = row.get("pipeline", "count")
    names = {"count": UPSTREAM + DOWNSTREAM, "reanalysis": DOWNSTREAM, "report": DOWNSTREAM[-1:]}[pipeline]
    return [Step(n, (steps or {}).get(n), (f"{n}/_SUCCESS",)) for n in names]


def select_steps(steps: list[Step], first: str | None = None, last: str | None = None, only: list[str] | None = None) -> list[Step]:
    """A range or a subset of steps; an unknown name is an error."""
    names = [s.name for s in steps]
    for n in [x for x in (first, last, *(only or [])) if x]:
        if n not in names:
            raise KeyError(f"no step {n!r}")
    a, b = names.index(first) if first else 0, names.index(last) if last else len(names) - 1
    return [s for k, s in enumerate(steps) if a <= k <= b and (not only or s.name in only)]


def output_status(outputs: DataFrame) -> DataFrame:
    """Per step of outputs(step, path, found): complete, partial, missing, or unknown without outputs."""
    n, k = F.count("path"), F.count_if("found")
    return outputs.groupBy("step").agg(F.when(n == 0, "unknown").when(k == n, "complete").when(k == 0, "missing").otherwise("partial").alias("status"))


def resume(status: DataFrame, manifest_status: str, enabled: bool = True) -> DataFrame:
    """Which steps can be skipped: those before the counts, if their outputs are complete and the inputs the same."""
    upstream = F.col("step").isin(*UPSTREAM)
    skip = upstream & (F.col("status") == "complete") & F.lit(enabled and manifest_status == "same")
    return status.withColumn("decision", F.when(skip, "skip").otherwise("run"))


def manifest_status(previous: DataFrame | None, current: DataFrame) -> str:
    """new, same, reordered, added or changed, of manifests(position, entry)."""
    if previous is None:
        return "new"
    lost = previous.select("entry").exceptAll(current.select("entry")).count()
    more = current.select("entry").exceptAll(previous.select("entry")).count()
    if lost:
        return "changed"
    if more:
        return "added"
    moved = previous.alias("a").join(current.alias("b"), "position").filter("a.entry <> b.entry").count()
    return "reordered" if moved else "same"


def manifest_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Per entry of two manifests: same, moved, added or removed."""
    a, b = previous.select("entry", F.col("position").alias("p")), current.select("entry", F.col("position").alias("q"))
    kind = F.when(F.col("p").isNull(), "added").when(F.col("q").isNull(), "removed").when(F.col("p") == F.col("q"), "same").otherwise("moved")
    return a.join(b, "entry", "full").select("entry", kind.alias("change"))


def preflight(jobs: DataFrame, exists: DataFrame, overwrite: bool = False) -> DataFrame:
    """What would stop a run: (job, step, problem, path) of jobs(job, position, step, skipped, role, path), role input or output.

    An input must exist, or be an output of an earlier or skipped step, or lie
    below one; an output of a step that runs must not exist yet, unless it may be
    overwritten.  exists(path) lists what is there.
    """
    there = exists.select("path").distinct().withColumn("found", F.lit(True))
    rows = jobs.join(there, "path", "left").withColumn("found", F.coalesce("found", F.lit(False)))
    made = rows.filter("role = 'output'").select("job", F.col("position").alias("at"), F.col("path").alias("made"), "skipped")
    wanted = rows.filter("role = 'input' and not skipped and not found").drop("skipped")
    # a path is covered by itself and by each folder above it
    parts = F.split("path", "/")
    above = wanted.withColumn("made", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))))
    covered = above.join(made, ["job", "made"]).filter("at < position").select("job", "step", "path").distinct()
    missing = wanted.join(covered, ["job", "step", "path"], "left_anti").select("job", "step", F.lit("missing input").alias("problem"), "path")
    if overwrite:
        return missing.distinct()
    clash = rows.filter("role = 'output' and not skipped and found").select("job", "step", F.lit("existing output").alias("problem"), "path")
    return missing.unionByName(clash).distinct()


class ManifestStore:
    """Input manifests in two phases: propose() records what a run tries, commit() makes it the one that later runs compare with."""

    def __init__(self, spark, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(context._jsc.hadoopConfiguration())

    def _read(self, name: str) -> DataFrame | None:
        path, fs = self._path(name)
        return self.spark.read.parquet(path.toString()) if fs.exists(path) else None

    def propose(self, current: DataFrame) -> str:
        """Write manifest(position, entry) as the tried one; returns its status against the committed one."""
        current.select("position", "entry").write.mode("overwrite").parquet(f"{self.folder}/tried")
        return manifest_status(self._read("committed"), self._read("tried"))

    def commit(self) -> bool:
        """After a successful run: the tried manifest replaces the committed one; False if nothing was tried.

        The old one is moved aside first and comes back if the move fails.
        """
        (tried, fs), (kept, _), (aside, _) = (self._path(n) for n in ("tried", "committed", "replaced"))
        if not fs.exists(tried):
            return False
        fs.delete(aside, True)
        if fs.exists(kept):
            fs.rename(kept, aside)
        if not fs.rename(tried, kept):
            fs.rename(aside, kept)
            raise RuntimeError(f"could not commit {tried.toString()}")
        fs.delete(aside, True)
        return True


def execute(steps: list[Step], context: dict, write: Callable[[str, DataFrame], None], done: Callable[[str], bool] = lambda name: False) -> list[tuple[str, str]]:
    """Run steps in order, writing each result; stops at the first that fails and names it."""
    out = []
    for s in steps:
        if done(s.name):
            out.append((s.name, "skipped"))
            continue
        try:
            if s.run:
                write(s.name, s.run(context))
            out.append((s.name, "done"))
        except Exception as e:  # noqa: BLE001  the summary names it
            out.append((s.name, f"failed: {e}"))
            break
    return out
