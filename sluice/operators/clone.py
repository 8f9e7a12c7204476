"""Cloning: what the receiver lacks of the sender."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .batch import clone_batches


def missing(sender: DataFrame, receiver: DataFrame, keys: tuple[str, ...] = ("_id",)) -> DataFrame:
    """Rows of sender whose key the receiver hasn't; only the receiver's keys are read."""
    return sender.join(receiver.select(*keys), list(keys), "left_anti")


def clone(sender: DataFrame, receiver: DataFrame, keys: tuple[str, ...] = ("_id",)) -> DataFrame:
    """The receiver after cloning: its own rows stay as they are. Cloning again adds nothing."""
    return receiver.unionByName(missing(sender, receiver, keys))


def batches(rows: DataFrame, coll: str, key: str, size: str, bound: int) -> DataFrame:
    return clone_batches(rows, coll, key, size, bound)


def not_received(sender_names: DataFrame, receiver_names: DataFrame, name: str = "name") -> DataFrame:
    return sender_names.select(name).distinct().join(receiver_names.select(name), name, "left_anti")


def received(sender_names: DataFrame, receiver_names: DataFrame, name: str = "name") -> DataFrame:
    return sender_names.select(name).distinct().join(receiver_names.select(name), name, "left_semi")
