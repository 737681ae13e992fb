"""Client and merchant dimensions kept up to date from the batches written since the last refresh.

Both dimensions merge from small states: one row per (account, channel) and one per merchant. The states of all
batches so far lie in a table of their own; a refresh reads only the silver folders that are not in them yet, merges,
and writes the dimensions from the states. A one-row manifest names the current states and the batches in them. It is
replaced by a rename, so a refresh that fails before leaves the old states valid and is simply done again.

A batch written again has the same source rows (its offsets are fixed), so a folder is merged once. Compaction
notes the batches inside a merged folder; if only some of them are in the states, or batches are gone
altogether, the states are built anew from all of silver.
"""

import json
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from ledgerpulse.operators import dims
from ledgerpulse.sources.tables import BATCH, merged_batches, overwrite_table, read_table, table_path
from ledgerpulse.storage import delete_folder

FOLDER = re.compile(rf"/date=([^/]+)/{BATCH}=(-?\d+)/")
PARTS = {"client": (dims.client_state, dims.merge_client_states, dims.client_dim_of, "gold.ClientDim"),
         "merchand": (dims.merchand_state, dims.merge_merchand_states, dims.merchand_dim_of, "gold.MerchandDim")}


def silver_folders(spark: SparkSession, root: str) -> dict[tuple[str, int], set[tuple[str, int]]]:
    """The (date, batch) pairs inside each folder of silver, from the file listing and the notes of compacted folders."""
    files = read_table(spark, root, "silver.features").inputFiles()
    folders = {(unquote(m[1]), int(m[2])) for m in map(FOLDER.search, files) if m}
    return {(day, b): {(day, c) for c in merged_batches(spark, root, "silver.features", day, b) or {b}}
            for day, b in folders}


def missing(done: set[tuple[str, int]], now: dict[tuple[str, int], set[tuple[str, int]]]) -> list | None:
    """Folders that hold no batch of ``done``; None if batches of ``done`` are gone or share a folder with others."""
    if not done <= set().union(*now.values()):
        return None
    new = [folder for folder, inside in now.items() if not inside & done]
    return None if any(inside & done and inside - done for inside in now.values()) else sorted(new)


class States:
    """The states below ``root`` and the manifest that says which are current."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.home, self.root = spark, f"{root}/state/dims", root
        self.hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.hadoop(self.home).getFileSystem(spark._jsc.hadoopConfiguration())

    def manifest(self) -> dict | None:
        # the rename leaves a moment without the current name: then the new one is complete
        for name in ("manifest", "manifest-next"):
            if self.fs.exists(self.hadoop(f"{self.home}/{name}/_SUCCESS")):
                row = self.spark.read.text(f"{self.home}/{name}").first()
                return json.loads(row["value"])
        return None

    def read(self, version: str, part: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.home}/{version}/{part}")

    def commit(self, version: str, batches: set[tuple[str, int]]) -> None:
        text = json.dumps({"version": version, "batches": sorted(batches)})
        following, current = f"{self.home}/manifest-next", f"{self.home}/manifest"
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(following)
        delete_folder(self.spark, current, self.home)
        self.fs.rename(self.hadoop(following), self.hadoop(current))


def refresh(spark: SparkSession, root: str, catalog: str | None = None) -> dict:
    """Bring both dimensions up to date; says how many folders were read and whether all were."""
    states, now = States(spark, root), silver_folders(spark, root)
    held = set().union(*now.values())
    old = states.manifest()
    done = {(d, b) for d, b in old["batches"]} if old else set()
    new = missing(done, now) if old else None
    rebuilt, version = new is None, old["version"] if old else None
    if new or rebuilt:
        version = uuid.uuid4().hex
        base = table_path(root, "silver.features")
        silver = read_table(spark, root, "silver.features")
        if not rebuilt:
            silver = (spark.read.schema(silver.schema).option("basePath", base)
                      .parquet(*[f"{base}/date={d}/{BATCH}={b}" for d, b in new]))
        for part, (build, merge, _, _) in PARTS.items():
            fresh = build(silver)
            if not rebuilt:
                fresh = fresh.unionByName(states.read(old["version"], part))
            merge(fresh).write.parquet(f"{states.home}/{version}/{part}")
    for part, (_, _, finish, table) in PARTS.items():
        overwrite_table(finish(states.read(version, part)), root, table, catalog)
    if old is None or version != old["version"]:
        states.commit(version, held)
        if old is not None:
            delete_folder(spark, f"{states.home}/{old['version']}", states.home)
    return {"folders": len(now if rebuilt else new), "rebuilt": rebuilt}
