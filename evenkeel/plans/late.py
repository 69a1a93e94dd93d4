"""Claim headers that land late: a new run computes the families they touch, and only those.

Landed rows and finals lie in slots, folders by a digest of the family. A run adds the
rows it has not seen to the landed ones, finds the families that these rows or a later
cutoff touch, resolves them anew, and writes the slots they lie in. All other slots stay
the files of earlier runs: they are neither read nor copied. One entry in a commit log
names the files of a run, so earlier runs stay readable as they were.

A row that is delivered again, in whatever file, is known by its content and touches
nothing. Exposure and dimensions are those of the first run; a change
of these touches any family and needs a full run (``finance.execute``).

Slots that the driver is told about are at most ``slots`` numbers.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.operators import claims
from evenkeel.schemas import TABLES
from evenkeel.session import stage
from evenkeel.sources.commits import CommitLog
from evenkeel.sources.tables import RunConflict, conform

SLOTS = 64
FAMILY = "claim_family_id"
FINAL = "fact_claim_header_final"
# Where a row came from is no part of what it says.
DELIVERY = ("source_file_id", "source_row_id", "run_id", "ingested_at")
_CONTENT = [c for c in TABLES["raw_claim_header"].names if c not in DELIVERY]


def _schema(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def unseen(delivered: DataFrame, known: DataFrame | None) -> DataFrame:
    """One row for each delivered content that no known row has, dealt out by slot.

    Known contents ride along and veto their group, so whole rows are shuffled once; the
    ranges of this shuffle give a task few slots to write, and cut a slot of many rows.
    A row without a family equals no known one.
    """
    key = ["slot", FAMILY, *[c for c in _CONTENT if c != FAMILY]]
    rows = delivered.withColumn("is_known", F.lit(False))
    if known is not None:
        rows = rows.unionByName(known.where(F.col(FAMILY).isNotNull()).select(
            *key, F.lit(True).alias("is_known")), allowMissingColumns=True)
    return (
        rows.repartitionByRange("slot", FAMILY, "version_number")
        .groupBy(*key)
        .agg(F.max("is_known").alias("is_known"), F.min(F.struct(*DELIVERY)).alias("delivery"))
        .where(~F.col("is_known"))
        .select(*key, "delivery.*")
        .select(*delivered.columns)
    )


@dataclass(frozen=True)
class LateRuns:
    """Runs over claim headers that share what has not changed between them."""

    spark: SparkSession
    root: str
    dimensions: tuple[DataFrame, DataFrame, DataFrame]  # members, markets, plans
    member_months: DataFrame
    slots: int = SLOTS

    @property
    def _log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/_runs")

    def entries(self) -> dict[str, dict]:
        """Committed runs, the earliest first."""
        return {e["run_id"]: e for e in self._log.entries()}

    def _slot(self, family: str):
        return F.pmod(F.xxhash64(family), F.lit(self.slots)).cast("int")

    def _numbers(self, df: DataFrame) -> list[int]:
        return sorted(r["slot"] for r in df.select("slot").distinct().collect())

    def _write(self, df: DataFrame, table: str, attempt: str) -> None:
        """One folder a slot; a slot of many rows is cut into several tasks by adaptive execution."""
        df.hint("rebalance", F.col("slot")).write.partitionBy("slot").parquet(
            f"{self.root}/{table}/{attempt}")

    def _read(self, table: str, schema: str, places: dict[int, str]) -> DataFrame:
        """The given slots, each from the attempt that wrote it."""
        by_attempt: dict[str, list[int]] = {}
        for slot, attempt in places.items():
            by_attempt.setdefault(attempt, []).append(slot)
        found = [
            self.spark.read.schema(f"{schema}, slot int").option("basePath", f"{self.root}/{table}/{a}").parquet(
                *[f"{self.root}/{table}/{a}/slot={s}" for s in sorted(slots)])
            for a, slots in by_attempt.items()]
        return reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame(
            [], f"{schema}, slot int")

    def _landed(self, entry: dict | None, schema: str, slots: list[int]) -> DataFrame:
        """Rows of the given slots that a run and those before it took in."""
        parts = [self._read("landed", schema, {s: attempt for s in slots if s in held})
                 for attempt, held in (entry["landed"] if entry else []) if set(slots) & set(held)]
        return reduce(DataFrame.unionByName, parts or [self._read("landed", schema, {})])

    def run(self, run_id: str, cutoff: date, rows: DataFrame) -> dict:
        """Takes rows in and publishes finals as of a cutoff; a committed run is given back.

        Of two runs that start from the same one, the first to commit stands and the
        other is refused.
        """
        done = self.entries()
        if run_id in done:
            if done[run_id]["cutoff"] != cutoff.isoformat():
                raise RunConflict(f"{run_id} was published as of {done[run_id]['cutoff']}")
            return done[run_id]
        parent = list(done.values())[-1] if done else None
        if parent and cutoff.isoformat() < parent["cutoff"]:
            raise RunConflict(f"the cutoff of {parent['run_id']} is later: {parent['cutoff']}")
        attempt = uuid.uuid4().hex
        delivered = conform(rows, "raw_claim_header").withColumns({
            "slot": self._slot(FAMILY)})
        schema = _schema(delivered, [c for c in delivered.columns if c != "slot"])
        delivered = stage(delivered, "delivered")
        known = self._landed(parent, schema, self._numbers(delivered)) if parent else None
        unseen(delivered, known).write.partitionBy("slot").parquet(f"{self.root}/landed/{attempt}")
        new = self.spark.read.schema(f"{schema}, slot int").parquet(f"{self.root}/landed/{attempt}")
        new_slots = self._numbers(new)

        # Families of new rows, and those with a version that the earlier cutoff held back.
        waiting = new.where(F.col("adjudicated_at") > F.lit(cutoff)).select("slot", FAMILY, "adjudicated_at")
        waiting.write.parquet(f"{self.root}/waiting/{attempt}")
        touched = new.select("slot", FAMILY)
        if parent:
            due = self.spark.read.schema(waiting.schema).parquet(
                *[f"{self.root}/waiting/{a}" for a, _ in parent["landed"]]).where(
                (F.col("adjudicated_at") > F.lit(date.fromisoformat(parent["cutoff"])))
                & (F.col("adjudicated_at") <= F.lit(cutoff)))
            touched = touched.unionByName(due.select("slot", FAMILY))
        touched = stage(touched.distinct(), "touched")
        slots = self._numbers(touched)

        landed = new
        if parent:
            landed = self._landed(parent, schema, slots).join(
                touched, ["slot", FAMILY], "left_semi").unionByName(new)
        finals = self._finals(landed, cutoff)
        held = {int(s): a for s, a in parent["finals"].items()} if parent else {}
        standing = self._read(FINAL, self._final_schema, {s: held[s] for s in slots if s in held}).join(
            touched.select("slot", F.col(FAMILY).alias("claim_family_key")), ["slot", "claim_family_key"], "left_anti")
        self._write(standing.unionByName(finals), FINAL, attempt)
        written = self._numbers(self.spark.read.schema(f"{self._final_schema}, slot int").parquet(
            f"{self.root}/{FINAL}/{attempt}"))
        entry = {
            "run_id": run_id, "cutoff": cutoff.isoformat(), "parent": parent["run_id"] if parent else None,
            "landed": [*(parent["landed"] if parent else []), [attempt, new_slots]],
            "finals": {str(s): a for s, a in held.items() if s not in slots} | {str(s): attempt for s in written},
            "recomputed": slots}

        def decide(entries: list[dict]) -> dict | None:
            return entry if (entries[-1]["run_id"] if entries else None) == entry["parent"] else None

        if self._log.append(decide) is None:
            raise RunConflict(f"another run was published after {entry['parent']}")
        return entry

    @property
    def _final_schema(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TABLES[FINAL] if f.name != "run_id")

    def _finals(self, landed: DataFrame, cutoff: date) -> DataFrame:
        """Finals of the landed rows, beside their slots."""
        run = F.lit("").alias("run_id")
        context = self.spark.range(1).select(run, F.lit(cutoff).alias("as_of_cutoff"))
        headers = claims.claim_header_versions(
            landed.drop("slot").withColumn("run_id", run), *self.dimensions, "")
        finals = claims.claim_finals(
            headers, self.member_months.withColumn("run_id", run), context, "")
        return finals.drop("run_id").withColumn("slot", self._slot("claim_family_key"))

    def finals(self, run_id: str) -> DataFrame:
        """The finals of a committed run."""
        held = self.entries()[run_id]["finals"]
        return self._read(FINAL, self._final_schema, {int(s): a for s, a in held.items()}).withColumn(
            "run_id", F.lit(run_id)).select(*TABLES[FINAL].names)

    def delta(self, earlier: str, later: str) -> DataFrame:
        """Families whose final differs between two runs, with the claim and cents of both.

        Slots that both runs share are not read.
        """
        runs = [self.entries()[r]["finals"] for r in (earlier, later)]
        sides = []
        for name, held, other in (("earlier", *runs), ("later", *runs[::-1])):
            df = self._read(FINAL, self._final_schema, {
                int(s): a for s, a in held.items() if other.get(s) != a})
            sides.append(df.select("claim_family_key", F.struct(*[
                c for c in TABLES[FINAL].names if c not in ("run_id", "claim_family_key")]).alias(name)))
        differing = sides[0].join(sides[1], "claim_family_key", "full").where("not (earlier <=> later)")
        return differing.select("claim_family_key", *[
            F.col(f"{side}.{column}").alias(f"{side}_{alias}") for side in ("earlier", "later")
            for column, alias in (("claim_version_key", "version_key"), ("header_paid_amount_cents", "cents"),
                                  ("population_match", "match"))])
