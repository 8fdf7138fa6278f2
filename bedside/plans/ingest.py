"""Decoded packets to stored readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import recode, without_low_bits
from ..functions.device import packed_device, packed_segment
from ..operators.asof import with_time
from ..operators.waveform import explode_samples

RECODED = ("SPO2", "PR", "HR", "RR", "TEMP", "BP_SYS", "BP_DIA", "BP_MAP",
           "CNIBP_SYS", "CNIBP_DIA", "CNIBP_MAP")
SHIFTED = ("ECG_I", "ECG_II", "ECG_III")


def unpacked(packets: DataFrame) -> DataFrame:
    """Device and segment from the packed id of a packet."""
    return packets.withColumn("device", packed_device(F.col("packed"))).withColumn(
        "segment", packed_segment(F.col("packed"))
    )


def numeric_readings(packets: DataFrame) -> DataFrame:
    """Numeric packets to readings with vendor codes turned to states."""
    value = F.col("value").cast("double")
    return packets.where("sn > 0").withColumn(
        "value", F.when(F.col("param").isin(*RECODED), recode(value)).otherwise(value)
    )


def waveform_samples(packets: DataFrame) -> DataFrame:
    """Waveform packets to samples; ECG loses its low eight bits."""
    shifted = F.transform(
        "samples",
        lambda x: F.when(F.col("param").isin(*SHIFTED), without_low_bits(x)).otherwise(x),
    )
    return explode_samples(packets.where("sn > 0").withColumn("samples", shifted))


def packet_counts(packets: DataFrame) -> DataFrame:
    return packets.groupBy("session", "block", "id").agg(F.count(F.lit(1)).alias("packets"))


def device_counts(packets: DataFrame) -> DataFrame:
    return packets.groupBy("session", "block", "device").agg(F.count(F.lit(1)).alias("packets"))


def block_devices(packets: DataFrame, order: str = "seq") -> DataFrame:
    """The device a block belongs to: the one of its first packet."""
    return packets.groupBy("session", "block").agg(F.min_by("device", order).alias("device"))


def block_spans(readings: DataFrame) -> DataFrame:
    """First and last time and the series of each block."""
    return readings.groupBy("session", "block").agg(
        F.min("t").alias("t0"),
        F.max("t").alias("t1"),
        F.array_sort(F.collect_set("param")).alias("params"),
    )


def readings_from_packets(numeric: DataFrame, waveforms: DataFrame | None, syncs: DataFrame) -> DataFrame:
    """Packets of all blocks to readings on one time axis.

    ``numeric`` (session, block, param, seq, sn, value), ``waveforms`` with
    samples, ``syncs`` (session, block, seq, sn, t) anchors.
    """
    rows = numeric_readings(numeric).select("session", "block", "param", "seq", "sn", "value")
    if waveforms is not None:
        samples = waveform_samples(waveforms).select(
            "session", "block", "param", "seq", "sn", F.col("value").cast("double").alias("value")
        )
        rows = rows.unionByName(samples)
    return with_time(rows, syncs)
