"""Deterministic archives: stored ZIPs with sorted members, fixed modes and times, checksums and a manifest."""

from __future__ import annotations

import io
import json
import time
import zipfile
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import ARCHIVE_TIME_HIGH, ARCHIVE_TIME_LOW
from ..functions.payload import MAX_MEMBERS, MAX_TOTAL_BYTES

BUNDLE = "archive_id string, members int, content binary, output_sha256 string, input_fingerprint string"


def pack(archive_id: str, members: list[tuple[str, bytes]], epoch: int) -> tuple[bytes, str]:
    """The archive's bytes and the fingerprint of its inputs: equal members give equal bytes."""
    at = min(max(epoch, ARCHIVE_TIME_LOW), ARCHIVE_TIME_HIGH)
    when = time.gmtime(at - at % 2)[:6]
    hashes = [(name, sha256(body).hexdigest()) for name, body in sorted(members)]
    sums = "".join(f"{h}  {name}\n" for name, h in hashes).encode()
    manifest = json.dumps({"archive_id": archive_id, "entries": [n for n, _ in hashes]}, sort_keys=True, separators=(",", ": ")).encode() + b"\n"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, body in sorted([*members, ("checksums.txt", sums), ("manifest.json", manifest)]):
            info = zipfile.ZipInfo(name, when)
            info.external_attr, info.create_system = 0o100644 << 16, 3
            z.writestr(info, body)
    return out.getvalue(), sha256(sums).hexdigest()


def build(members: DataFrame) -> DataFrame:
    """One archive for each archive_id of (archive_id, epoch, path, content).

    An archive is made in one task, and its limits (members and bytes) are what bounds that task; an aggregation asks them before
    anything is collected, and more is an error."""
    sizes = members.groupBy("archive_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("content")).alias("bytes"))
    over = sizes.where((F.col("n") > MAX_MEMBERS) | (F.col("bytes") > MAX_TOTAL_BYTES)).select("archive_id").limit(1).collect()
    if over:
        raise ValueError(f"{over[0]['archive_id']} is over the limits of an archive")

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        raw, fingerprint = pack(key[0], list(zip(rows["path"], map(bytes, rows["content"]), strict=True)), int(rows["epoch"].iloc[0]))
        return pd.DataFrame([(key[0], len(rows), raw, sha256(raw).hexdigest(), fingerprint)], columns=["archive_id", "members", "content", "output_sha256", "input_fingerprint"])

    return members.groupBy("archive_id").applyInPandas(one, BUNDLE)
