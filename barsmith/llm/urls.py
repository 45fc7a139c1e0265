"""URL filter: a sorted digest array of host and path rules.

A rule (host, path, verdict) fits a URL whose host is the rule's host or one of its
subdomains and whose path starts with the rule's path; the longest rule (host and path
together, then the longer host) wins. The rules' strings are hashed with 64-bit XXH64; the
sorted keys, the strings and the verdicts are one file in the shared folder, which Spark
ships to every executor. A Python worker memory-maps it. For a batch of URLs it probes
the keys of all host suffixes with one vectorised binary search, then, for hosts that have
rules, the keys of host and path beginnings of the rules' lengths. A stored string is
compared with every hit, so a hash collision can't give a verdict.

Suffixes have at most as many labels as the rules' longest host, and only path
lengths that rules have are probed, so a long URL costs no more than a short one. More than
``max_rules`` rules are refused, not cut: that bounds the file.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path:
from there up to ``?``, ``#`` or the end. Null URLs, and those without ``://``, have empty
host and path, which no rule fits. Without a rule the verdict is ``default``. Every row is judged by its own
URL, whatever ids repeat; of rules with one host and path the last given holds. Empty tables
give empty results; extra columns pass through, result columns get underscores in front
where their names are taken.
"""

from __future__ import annotations

import uuid
from typing import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm.common import ascii_lower, free_name, scratch_path


def url_host(url):
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url):
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def pack(strings: list[str], notes: list[str]) -> bytes:
    """Count, sorted keys, ends of the strings, ends of the notes, then their bytes."""
    raw = sorted((xxhash.xxh64_intdigest(s.encode()), s.encode(), t.encode()) for s, t in zip(strings, notes, strict=True))
    keys = np.array([h for h, _, _ in raw], np.uint64)
    ends = np.cumsum([0] + [len(x) for _, s, t in raw for x in (s, t)]).astype(np.uint64)
    return np.uint64(len(raw)).tobytes() + keys.tobytes() + ends.tobytes() + b"".join(s + t for _, s, t in raw)


class DigestArray:
    """A packed file, memory-mapped."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n = int(raw[:8].view(np.uint64)[0])
        self.keys = raw[8:8 + 8 * n].view(np.uint64)
        self.ends = raw[8 + 8 * n:8 + 8 * n + 8 * (2 * n + 1)].view(np.uint64)
        self.text = raw[8 + 8 * n + 8 * (2 * n + 1):]

    def _piece(self, i: int) -> bytes:
        return self.text[int(self.ends[i]):int(self.ends[i + 1])].tobytes()

    def find(self, strings: list[bytes]) -> list[str | None]:
        """The note of each string, or None."""
        h = np.fromiter(map(xxhash.xxh64_intdigest, strings), np.uint64, len(strings))
        at = np.searchsorted(self.keys, h)
        out: list[str | None] = [None] * len(strings)
        for j in (at < len(self.keys)).nonzero()[0]:
            i = int(at[j])
            while i < len(self.keys) and self.keys[i] == h[j]:  # several strings may have one key
                if self._piece(2 * i) == strings[j]:
                    out[j] = self._piece(2 * i + 1).decode()
                    break
                i += 1
        return out


def ship(spark: SparkSession, content: bytes, name: str) -> str:
    """Put a file in the shared folder and have Spark fetch it to every executor."""
    path = f"{scratch_path(spark, 'files')}/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hadoop)
    for i in range(0, len(content), 1 << 20):
        out.write(bytearray(content[i:i + (1 << 20)]))
    out.close()
    spark.sparkContext.addFile(path)
    return path.rpartition("/")[2]


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]], *, url: str = "url", default: str = "allow",
          max_rules: int = 5_000_000) -> DataFrame:
    """``pages`` with host, path, rule (host and path of the winning rule, or null) and verdict.

    ``rules``: (host, path, verdict), the path empty or starting with ``/``; of two rules
    with equal host and path the last counts.
    """
    table = {}
    for host, path, verdict in rules:
        if path[:1] not in ("", "/") or not host or "/" in host:
            raise ValueError(f"not a rule: {host!r}, {path!r}")
        table[host.lower(), path] = verdict
        if len(table) > max_rules:
            raise ValueError(f"more than {max_rules} rules")
    spark = pages.sparkSession
    of_host: dict[str, set[int]] = {}
    for host, path in table:
        of_host.setdefault(host, set()).add(len(path.encode()))
    hosts_file = ship(spark, pack(list(of_host), [",".join(map(str, sorted(x, reverse=True))) for x in of_host.values()]), "hosts")
    rules_file = ship(spark, pack([h + p for h, p in table], list(table.values())), "rules")
    labels = max((h.count(".") + 1 for h in of_host), default=0)

    @F.pandas_udf("rule string, verdict string")
    def probe(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        hosts, rules = (DigestArray(SparkFiles.get(f)) for f in (hosts_file, rules_file))
        for host, path in batches:
            row, suffix = [], []
            for i, h in enumerate(host):
                parts = h.rsplit(".", labels)
                for j in range(max(0, len(parts) - labels), len(parts)):
                    row.append(i)
                    suffix.append(".".join(parts[j:]).encode())
            at, whole = [], []
            for i, s, lengths in zip(row, suffix, hosts.find(suffix), strict=True):
                if lengths is not None:
                    p = path[i].encode()
                    for n in map(int, lengths.split(",")):
                        if n <= len(p):
                            at.append((i, len(s) + n, len(s)))
                            whole.append(s + p[:n])
            best: dict[int, tuple] = {}
            for (i, n, m), s, verdict in zip(at, whole, rules.find(whole), strict=True):
                if verdict is not None and (i not in best or (n, m) > best[i][0]):
                    best[i] = (n, m), s.decode(errors="replace"), verdict
            yield pd.DataFrame([best[i][1:] if i in best else (None, default) for i in range(len(host))],
                               columns=["rule", "verdict"], dtype=object)

    names = [free_name(pages.columns, c) for c in ("host", "path", "rule", "verdict")]
    u, j = F.col(f"`{url}`"), free_name(pages.columns, "_judged")
    out = pages.withColumn(names[0], url_host(u)).withColumn(names[1], url_path(u))
    out = out.withColumn(j, probe(F.col(names[0]), F.col(names[1])))
    return out.select(*[F.col(f"`{c}`") for c in [*pages.columns, *names[:2]]],
                      F.col(f"{j}.rule").alias(names[2]), F.col(f"{j}.verdict").alias(names[3]))
