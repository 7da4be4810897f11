"""Operators over parents, pins, seals and the published catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shared_digests(child: DataFrame, parent: DataFrame) -> DataFrame:
    """Paths of the child whose digest is also in the parent."""
    return child.join(parent.select("sha256").distinct(), "sha256", "left_semi").select("path")


def pin_status(depends: DataFrame, parents: DataFrame) -> DataFrame:
    """depends: child, parent_id, parent_version, pin.  parents: parent_id, parent_version, hashes (array) -- each dependency's status."""
    both = depends.join(parents.withColumn("there", F.lit(True)), ["parent_id", "parent_version"], "left")
    status = (
        F.when(F.col("parent_id").isNull() | F.col("parent_version").isNull(), "invalid-depends-on").when(F.col("there").isNull(), "dangling-parent")
        .when(F.col("pin").isNull(), "parent-manifest-pin-missing").when(~F.array_contains("hashes", F.col("pin")), "parent-manifest-pin-mismatch").otherwise("ok")
    )
    return both.select("child", "parent_id", "parent_version", status.alias("status"))


def presence(listed: DataFrame, objects: DataFrame) -> DataFrame:
    """code, path: published objects that are gone or of another size."""
    both = listed.join(objects, "path", "left")
    code = F.when(F.col("length").isNull(), "object-gone").when(F.col("length") != F.col("bytes"), "object-resized")
    return both.select(code.alias("code"), "path").filter("code is not null")


def checksum_differences(sealed: DataFrame, observed: DataFrame) -> DataFrame:
    """path, sealed, observed: where both are known and differ.  Each side: path, crc."""
    both = sealed.select("path", F.col("crc").alias("sealed")).join(observed.select("path", F.col("crc").alias("observed")), "path")
    return both.filter(F.col("sealed") != F.col("observed"))
