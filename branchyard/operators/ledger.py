"""Commits, and the ledger of the refs' moves.

A commit is written once: which content each table key has, and ``seen``, the
last commit it includes of each lane. A lane is one life of a ref, from its
creation to its drop; its commits follow each other. So "is an ancestor of" is one
comparison, and the last common ancestor comes from comparing two maps, without
walking or reading the history.

The ledger has one short row for each move of a ref, whatever the number of
tables; the last row of a ref says where it points. A commit made on a ref has the
number of its move there as its position in the lane.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOVE_SCHEMA = (
    "ref string, seq bigint, ref_type string, ref_lane string, action string, hash string,"
    " stream string, stream_batch bigint"
)

COMMIT_SCHEMA = (
    "hash string, parent string, parent2 string, lane string, pos bigint, depth bigint,"
    " message string, tables map<string,string>, seen map<string,struct<pos:bigint,depth:bigint>>"
)

NAMESPACE = "namespace"


def new_commit(parents: list[dict], lane: str, pos: int, message: str, tables: dict[str, str]) -> dict:
    """A commit on top of one or two parents."""
    depth = 1 + max(parent["depth"] for parent in parents) if parents else 0
    seen: dict[str, dict] = {}
    for parent in parents:
        for name, last in parent["seen"].items():
            seen[name] = max(last, seen.get(name, last), key=lambda entry: entry["pos"])
    seen[lane] = {"pos": pos, "depth": depth}
    commit = {
        "parent": parents[0]["hash"] if parents else None,
        "parent2": parents[1]["hash"] if len(parents) > 1 else None,
        "lane": lane,
        "pos": pos,
        "depth": depth,
        "message": message,
        "tables": tables,
        "seen": seen,
    }
    commit["hash"] = hashlib.sha256(json.dumps(commit, sort_keys=True).encode()).hexdigest()
    return commit


def next_move(ref: str, last: dict | None, action: str, commit_hash: str, **more) -> dict:
    """The ledger row after ``last`` on ``ref``, pointing at a commit."""
    seq = 0 if last is None else last["seq"] + 1
    opens = last is None or last["action"] == "dropped"
    return {
        "ref": ref,
        "seq": seq,
        "ref_type": "Branch",
        "ref_lane": f"{ref}.{seq}" if opens else last["ref_lane"],
        "action": action,
        "hash": commit_hash,
        **more,
    }


def includes(state: dict, commit: dict) -> bool:
    """True if ``commit`` is ``state``'s commit or an ancestor of it."""
    last = state["seen"].get(commit["lane"])
    return last is not None and last["pos"] >= commit["pos"]


def last_common(a: dict, b: dict) -> tuple[str, int]:
    """Lane and position of the deepest commit that both states include.

    Of a lane both include what the one behind has; the deepest of these is the
    last common commit. The first commit of the store is in every state.
    """
    both = {
        lane: min(a["seen"][lane], b["seen"][lane], key=lambda last: last["pos"])
        for lane in a["seen"].keys() & b["seen"].keys()
    }
    lane = max(both, key=lambda name: (both[name]["depth"], name))
    return lane, both[lane]["pos"]


def included_in(seen: dict[str, dict]) -> Column:
    """A filter over commits: those that a state with this ``seen`` includes."""
    last = {lane: entry["pos"] for lane, entry in seen.items()}
    positions = F.from_json(F.lit(json.dumps(last)), "map<string,bigint>")
    return F.coalesce(F.try_element_at(positions, F.col("lane")) >= F.col("pos"), F.lit(False))


def latest_per_ref(moves: DataFrame) -> DataFrame:
    """The last row of each ref that is not dropped.

    ``max_by`` combines on the map side, so a ref with most of the ledger's
    rows does not end in one task.
    """
    order = F.struct("seq", "hash")
    last = moves.groupBy("ref").agg(F.max_by(F.struct(*moves.columns), order).alias("last"))
    return last.select("last.*").filter(F.col("action") != "dropped")
