"""R1 + R2 on a stream: count clicks per (user, day, ad), list users that
reach the threshold, and drop the clicks of listed users.

State is kept per user by ``applyInPandasWithState``: a listed flag and one
counter per (day, ad).  It lives in the query's state store, versioned with
each micro-batch, so a replayed batch starts again from the state before it.
All of a user's rows of one micro-batch form one pandas frame in one task, so
a user with most of a large batch is that task's memory: bound the batch at
the source, or use the form on tables (``start_blacklist_tables``), which has
no such frame and is what the pipeline runs.  A listed user keeps only the
flag; with ``watermark``, counters of days wholly behind it are dropped.  A
user ever seen keeps a state row.

Modes:

* ``batch`` - the reference: membership is read when the batch starts, so
  all clicks of a user not yet listed pass, and the counters are updated
  with all clicks of the batch afterwards.
* ``row`` - exact per click: a click passes unless an earlier click listed
  its user; the click that lists a user passes.  Equals the batch operator
  ``ads_not_blacklisted`` whatever the batch cuts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from clickscope.config import BLACKLIST_THRESHOLD

OUTPUT_SCHEMA = ("kind STRING, ts TIMESTAMP, event_id BIGINT, area STRING, city STRING, "
                 "user_id STRING, ads_id STRING, day STRING")
STATE_SCHEMA = "listed BOOLEAN, counter_keys ARRAY<STRING>, counter_values ARRAY<BIGINT>"
_COLS = ["ts", "event_id", "area", "city", "user_id", "ads_id", "day"]
_SEP = "\u001f"


def _blacklist_step(threshold: int, mode: str, zone: str | None = None):
    """``zone``: the session time zone in which ``day`` is cut, if the stream has a watermark."""
    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            listed, keys, values = state.get
            counters = dict(zip(list(keys or []), [int(v) for v in (values or [])]))
        else:
            listed, counters = False, {}
        pdf = pd.concat(list(frames), ignore_index=True)
        pdf = pdf.sort_values(["ts", "event_id"], kind="stable").reset_index(drop=True)
        ckey = pdf["day"].astype(str) + _SEP + pdf["ads_id"].astype(str)
        # running count of each click's counter, starting from the state
        running = ckey.map(counters).fillna(0).astype("int64") + pdf.groupby(ckey).cumcount() + 1
        hits = (running >= threshold).to_numpy().nonzero()[0]
        lister = None if listed or not len(hits) else int(hits[0])
        if listed:
            passed = pdf.iloc[0:0]
        elif mode == "row" and lister is not None:
            passed = pdf.iloc[: lister + 1]
        else:
            passed = pdf
        now_listed = bool(listed or lister is not None)
        if now_listed:
            # listing is for ever: the counters of a listed user are not needed
            counters = {}
        else:
            for k, n in ckey.value_counts().items():
                counters[k] = counters.get(k, 0) + int(n)
            wm = state.getCurrentWatermarkMs() if zone else 0
            if wm > 0:
                # a day wholly behind the watermark gets no more clicks
                oldest = pd.Timestamp(wm, unit="ms", tz="UTC").tz_convert(zone).strftime("%Y-%m-%d")
                counters = {k: v for k, v in counters.items() if k.split(_SEP, 1)[0] >= oldest}
        state.update((now_listed, list(counters.keys()), [int(v) for v in counters.values()]))
        out = passed[_COLS].assign(kind="pass")
        if lister is not None:
            listing = pdf.iloc[[lister]][_COLS].assign(kind="listed")
            out = listing if out.empty else pd.concat([out, listing], ignore_index=True)
        yield out[["kind", *_COLS]]

    return step


def blacklist_stream(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD,
                     mode: str = "batch", watermark: str | None = None) -> DataFrame:
    """Streaming frame of ``kind`` = 'pass' rows (clicks that pass the
    blacklist) and 'listed' rows (the click that listed a user).

    ``watermark`` (e.g. "1 day") drops the counters of days behind it."""
    if mode not in ("batch", "row"):
        raise ValueError("mode is 'batch' or 'row'")
    src = clicks
    if "event_id" not in src.columns:
        src = src.withColumn("event_id", F.lit(0).cast("bigint"))
    src = src.select(*_COLS)
    zone = None
    if watermark:
        src, zone = src.withWatermark("ts", watermark), src.sparkSession.conf.get("spark.sql.session.timeZone")
    return src.groupBy("user_id").applyInPandasWithState(
        _blacklist_step(threshold, mode, zone), OUTPUT_SCHEMA, STATE_SCHEMA, "append",
        GroupStateTimeout.NoTimeout)
