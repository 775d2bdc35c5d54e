"""Per-user key and value profiles: the last value written wins, listed users are refused."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.aggregates import last_by_key
from millrace.streaming.queries import run_to_files, state_rows, state_variables

# Fixed value: the user whose requests are refused.
REFUSED = ("hacker",)


def accepted(updates: DataFrame, user: str, refused: Sequence[str] = REFUSED) -> DataFrame:
    return updates.where(~F.col(user).cast("string").isin(*refused))


def latest_profiles(
    updates: DataFrame, user: str, key: str, value: str, order: Sequence[str], refused: Sequence[str] = REFUSED
) -> DataFrame:
    """One row per user and key with the value written last."""
    return last_by_key(accepted(updates, user, refused), [user, key], order, [value])


def profile_maps(profiles: DataFrame, user: str, key: str, value: str) -> DataFrame:
    """Profiles as one map per user, for users with a known, small number of keys."""
    return profiles.groupBy(user).agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("data"))


def _newest(batch: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    return batch.sort_values("at", kind="stable", na_position="first").drop_duplicates(keys, keep="last")


def _newest_of_each_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Only the newest value of a user's key within an Arrow batch, so that busy users send little."""
    for batch in batches:
        yield _newest(batch, ["username", "key"])


class _Upserting(StatefulProcessor):
    """One map per user: key to (value, when it was written)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.profile = handle.getMapState("profile", "key string", "value string, at string")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for batch in rows:
            newest = _newest(batch, ["key"])
            plain = newest[["key", "value", "at"]].astype(object).where(newest[["key", "value", "at"]].notna(), None)
            changed = []
            for name, value, at in plain.itertuples(index=False):
                known = self.profile.getValue((name,)) if self.profile.containsKey((name,)) else None
                if known is None or (at or "") >= (known[1] or ""):
                    self.profile.updateValue((name,), (value, at))
                    changed.append((key[0], name, value, at))
            yield pd.DataFrame(changed, columns=["username", "key", "value", "at"], dtype=object)

    def close(self) -> None:
        pass


class ProfileStore:
    """Streaming upsert of (username, key, value, at) updates into map state, one map per user.

    The newest value by `at` stays, of equal ones that of the later micro-batch; a
    missing `at` is older than all others.  Only the maps of a micro-batch's own users
    are read, and of these only the keys that it writes.
    """

    SCHEMA = "username string, key string, value string, at string"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.changes, self.checkpoint = spark, f"{folder}/changes", f"{folder}/progress"

    def run(self, stream: DataFrame) -> None:
        """Take in what has arrived; the accepted changes are appended to a log of files."""
        updates = accepted(stream, "username").select("username", "key", "value", "at")
        with state_variables(self.spark):
            stored = (
                updates.mapInPandas(_newest_of_each_batch, self.SCHEMA)
                .groupBy("username")
                .transformWithStateInPandas(_Upserting(), self.SCHEMA, outputMode="Append", timeMode="None")
            )
            run_to_files(stored, self.changes, self.checkpoint)

    def profiles(self) -> DataFrame:
        state = state_rows(self.spark, self.checkpoint, "profile")
        return state.select("key.username", "user_map_key.key", "user_map_value.value")
