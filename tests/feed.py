"""A message feed of small files for the streaming tests, read in the order of arrival."""

import math
import os
import time

from urbanpulse import schemas as S
from urbanpulse.sources import bronze as B


def write_files(messages, path, rows_per_file):
    """Files of about ``rows_per_file`` messages by arrival time, behind those already there; returns how many."""
    before = set(os.listdir(path)) if os.path.exists(path) else set()
    n = max(1, math.ceil(messages.count() / rows_per_file))
    (messages.repartitionByRange(n, "timestamp").sortWithinPartitions("timestamp", "offset").write.mode("append").parquet(path))
    new = sorted(f for f in os.listdir(path) if f.startswith("part-") and f not in before)
    start = time.time() - 3_600 + 60 * len(before)
    for k, f in enumerate(new):  # a file stream reads by modification time
        os.utime(os.path.join(path, f), (start + k, start + k))
    return len(new)


def stream(spark, path, files_per_trigger):
    return B.read_table_stream(spark, path, S.MESSAGE_SCHEMA, max_files_per_trigger=files_per_trigger)
