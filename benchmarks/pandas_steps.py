"""The same steps in pandas, in memory on one core, for comparison with ``bench.py``.

``python benchmarks/pandas_steps.py [sf_dir]`` prints one JSON line of seconds per step.
"""

from __future__ import annotations

import io
import json
import sys
import time

import duckdb
import numpy as np
import pandas as pd

from pedalstrata.verification.oracle import _HOUR_DIRTY, _HOUR_RAW


def first_value(values: pd.Series):
    present = values.dropna()
    return present.iloc[0] if len(present) else None


def half_up(values: pd.Series):
    return int(np.trunc(values.mean() + 0.5)) if values.notna().any() else None


def rollup(hours: pd.DataFrame) -> pd.DataFrame:
    kinds = dict.fromkeys(("season", "yr", "mnth", "holiday", "weekday", "workingday"), first_value)
    kinds |= {"weathersit": half_up}
    kinds |= dict.fromkeys(("temp", "atemp", "hum", "windspeed"), "mean")
    kinds |= dict.fromkeys(("casual", "registered", "cnt"), "sum")
    ordered = hours.assign(order=hours["instant"].astype("int64")).sort_values("order", kind="stable")
    days = ordered.groupby("dteday", sort=True).agg(kinds).round(6).reset_index()
    days.insert(0, "instant", range(1, len(days) + 1))
    return days


def clean(hours: pd.DataFrame) -> pd.DataFrame:
    kept = hours.dropna(subset=["dteday", "cnt"])
    dates = pd.to_datetime(kept["dteday"], errors="coerce")
    return kept.assign(dteday=dates)[dates.notna()]


def latest(hours: pd.DataFrame) -> pd.DataFrame:
    typed = hours.assign(
        instant=pd.to_numeric(hours["instant"], errors="coerce").astype("Int64"),
        dteday=pd.to_datetime(hours["dteday"], errors="coerce"),
    )
    rest = [c for c in typed.columns if c not in ("instant", "dteday")]
    newest = typed.sort_values(["dteday", *rest], ascending=False, na_position="last")
    return newest.drop_duplicates("instant")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from read_parquet('{sf_dir}/lineitem.parquet')")
    raw = con.execute(f"with {_HOUR_RAW} select * from hour_raw").df()
    dirty = con.execute(f"with {_HOUR_DIRTY} select * from hour_dirty").df()
    seconds = {}

    def timed(name, f, *args):
        start = time.perf_counter()
        out = f(*args)
        seconds[name] = round(time.perf_counter() - start, 3)
        return out

    timed("rollup_day", rollup, raw)
    timed("clean", clean, dirty)
    timed("top1_per_key", latest, dirty)
    text = io.StringIO()
    timed("write_csv", lambda: dirty.to_csv(text, index=False))
    text.seek(0)
    timed("read_csv", pd.read_csv, text)
    print(json.dumps({"rows": len(raw), "seconds": seconds}))


if __name__ == "__main__":
    main()
