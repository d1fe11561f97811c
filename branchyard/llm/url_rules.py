"""URL rules by a sort-merge range join.

A host's labels in reverse order, each with a dot behind it, make a key (``www.example.net`` is
``net.example.www.``), and with the path behind it a canonical key of the URL. A rule for a host
and all its subdomains is then a prefix of keys, that is an interval. URLs and rules are dealt by
key into ranges and sorted there; a sweep over each range keeps a stack of the rules whose
intervals are open, the innermost on top. A rule's path is compared for the URLs within its
interval. The longest rule that fits (host and path together, then host) decides; of equal rules
``block`` does.

The ranges come from a bounded sample of keys, so they differ in size but never in what they
hold: every URL is in one range, every rule in all ranges that its interval meets. A key that a
large part of all rows share fills several ranges, over which its rows are spread. A range's rows
are read as a stream; only the open rules are held.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no rule.
Repeated rows give repeated rows, null ids stay null. Without rules every URL gets the default
verdict; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchyard.llm.common import column, python_tasks

#: Ranges for each shuffle partition, and keys that are looked at for each range.
RANGES, SAMPLES = 4, 32
#: Characters of a key that a range's border has at most.
BORDER = 256
LAST = "\U0010ffff"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDRESS = r"://([^/?#]*)([^?#]*)"


def with_host_and_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host and path: what stands behind the first ``://``, up to ``?``, ``#`` or the end."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host = F.translate(F.regexp_extract(url, ADDRESS, 1), UPPER, LOWER)
    return pages.withColumn("host", host).withColumn("path", F.regexp_extract(url, ADDRESS, 2))


def reversed_host(host):
    """The labels in reverse order, each with a dot behind it; nothing for no host."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _rows_into_ranges(batches: Iterator[pa.RecordBatch], borders: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, paths = column(batch, "host_key").to_pylist(), column(batch, "path").to_pylist()
        spread = column(batch, "spread").to_pylist()
        ranges = []
        for key, path, n in zip(keys, paths, spread):
            low, high = bisect_left(borders, key + path), bisect_right(borders, key + path)
            ranges.append(low + n % (high - low + 1))
        yield batch.append_column("range", pa.array(ranges, pa.int32()))


def _rules_into_ranges(batches: Iterator[pa.RecordBatch], borders: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, ranges = [], []
        for k, key in enumerate(column(batch, "host_key").to_pylist()):
            met = range(bisect_left(borders, key), bisect_right(borders, key + LAST) + 1)
            at += [k] * len(met)
            ranges += met
        yield batch.take(pa.array(at, pa.int32())).append_column("range", pa.array(ranges, pa.int32()))


class Open:
    """Rules of one host: their intervals are open while keys begin with ``prefix``."""

    def __init__(self, prefix: str, host: str) -> None:
        self.prefix, self.host = prefix, host
        self.verdicts: dict[str, str] = {}
        self.lengths: set[int] = set()

    def add(self, path: str, verdict: str) -> None:
        if self.verdicts.get(path) != "block":
            self.verdicts[path] = verdict
        self.lengths.add(len(path))

    def longest(self, path: str) -> str | None:
        return next((path[:n] for n in sorted(self.lengths, reverse=True) if path[:n] in self.verdicts and n <= len(path)), None)


def _swept(batches: Iterator[pa.RecordBatch], default: str) -> Iterator[pa.RecordBatch]:
    stack: list[Open] = []
    current = None
    for batch in batches:
        out = {"id": [], "host": [], "path": [], "rule": [], "verdict": []}
        for row in batch.to_pylist():
            if row["range"] != current:
                stack, current = [], row["range"]
            key = row["host_key"]
            while stack and not key.startswith(stack[-1].prefix):
                stack.pop()
            if row["is_url"]:
                found = [(len(open_.host) + len(path), len(open_.host), open_.host + path, open_.verdicts[path]) for open_ in stack if (path := open_.longest(row["path"])) is not None]
                best = max(found, default=(0, 0, None, default))
                for name, value in zip(out, (row["id"], row["host"], row["path"], best[2], best[3])):
                    out[name].append(value)
            else:
                if not stack or stack[-1].prefix != key:
                    stack.append(Open(key, row["host"]))
                stack[-1].add(row["path"], row["verdict"])
        yield pa.record_batch(list(map(pa.array, out.values(), (pa.int64(), *[pa.string()] * 4))), names=list(out))


def judged_urls(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) of each row of ``pages``; rule is the host and path of the rule that decides, or null.

    ``rules`` has the columns host, path (may be empty) and verdict (``allow`` or ``block``); rules
    without a host are left out. ``default`` is the verdict where no rule fits.
    """
    spark = pages.sparkSession
    python_tasks(spark)
    urls = with_host_and_path(pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url")))
    urls = urls.select("id", "host", "path", reversed_host(F.col("host")).alias("host_key"), F.pmod(F.xxhash64("id", "url"), F.lit(1 << 30)).alias("spread"))
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    drawn = urls.select(F.substring(F.concat("host_key", "path"), 1, BORDER).alias("key"), "spread").orderBy("spread", "key").limit(ranges * SAMPLES)
    sample = sorted(row["key"] for row in drawn.collect())  # ranges * SAMPLES rows at most
    borders = sample[SAMPLES // 2 :: SAMPLES]
    lower = F.translate(F.col("host"), UPPER, LOWER)
    kept = rules.where("host <> ''").select(lower.alias("host"), F.coalesce("path", F.lit("")).alias("path"), reversed_host(lower).alias("host_key"), "verdict").distinct()
    schema = "id long, host string, path string, host_key string, verdict string, is_url boolean"
    urls = urls.mapInArrow(lambda batches: _rows_into_ranges(batches, borders), "id long, host string, path string, host_key string, spread long, range int")
    kept = kept.mapInArrow(lambda batches: _rules_into_ranges(batches, borders), "host string, path string, host_key string, verdict string, range int")
    names = [field.split()[0] for field in schema.split(", ")] + ["range"]
    urls = urls.withColumns({"verdict": F.lit(None).cast("string"), "is_url": F.lit(True)}).select(names)
    kept = kept.withColumns({"id": F.lit(None).cast("long"), "is_url": F.lit(False)}).select(names)
    rows = urls.union(kept).repartition("range").sortWithinPartitions("range", "host_key", "is_url")
    return rows.mapInArrow(lambda batches: _swept(batches, default), "id long, host string, path string, rule string, verdict string")
