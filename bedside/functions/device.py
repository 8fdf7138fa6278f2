"""Device ids, serial numbers and packed fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_YEAR = 13


def serial_number(device_id: Column) -> Column:
    """``????20YYMMNNNNN`` from year (6 bits from 2013), month (4) and serial (14)."""
    year = F.shiftright(device_id, 18).bitwiseAND(0x3F) + FIRST_YEAR
    month = F.shiftright(device_id, 14).bitwiseAND(0xF)
    serial = device_id.bitwiseAND(0x3FFF)
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.concat(F.lit("????20"), pad(year, 2), pad(month, 2), pad(serial, 5))


def device_id(serial_no: Column) -> Column:
    """Device id of a 9 or 15 character serial number, -1 when it has none."""
    short = F.when(F.length(serial_no) == 15, F.substring(serial_no, 7, 9)).otherwise(serial_no)
    number = lambda start, n: F.substring(short, start, n).try_cast("bigint")
    year, month, serial = number(1, 2), number(3, 2), number(5, 5)
    packed = (
        serial.bitwiseAND(0x3FFF)
        .bitwiseOR(F.shiftleft(month.bitwiseAND(0xF), 14))
        .bitwiseOR(F.shiftleft((year - FIRST_YEAR).bitwiseAND(0x3F), 18))
    )
    ok = (F.length(short) == 9) & (year >= FIRST_YEAR) & (serial <= 16383)
    return F.when(ok & packed.isNotNull(), packed).otherwise(F.lit(-1).cast("bigint"))


def packed_device(value: Column) -> Column:
    return F.shiftright(value, 8)


def packed_segment(value: Column) -> Column:
    return value.bitwiseAND(255)
