"""Names, dates, bit masks and other scalar rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of the quality flag.
FLAG_BITS = {1: "other night", 2: "manual master", 4: "sanity false", 8: "lenient keys", 16: "across a wall", 32: "hard keys ignored"}
#: Aliases of image types in free parameters.
TYPE_ALIASES = {"bias": "bias", "zero": "bias", "dark": "dark", "flat": "flat", "science": "science", "sci": "science", "object": "science"}
FILTERS = ("u", "g", "r", "i", "z")
UNIT = r"SU(?:0[1-9]|1\d|20)"
"""Default pattern of the names of instruments; the functions that look for one take another."""


def nightdate(ts: Column) -> Column:
    """The date 15 hours before UTC."""
    return (ts - F.expr("INTERVAL 15 HOURS")).cast("date")


def master_date(night: Column) -> Column:
    """Masters carry the date after the night."""
    return F.date_add(night, 1)


def compact_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def mjd(ts: Column) -> Column:
    """Modified Julian date of a UTC timestamp."""
    return F.unix_micros(ts.cast("timestamp")) / 86_400_000_000 + 40587


def mjd_or_fallback(mjd_: Column, mjd_obs: Column, jd: Column, date_obs: Column) -> Column:
    """The first that is present of MJD, MJD-OBS, JD - 2400000.5 and the MJD of DATE-OBS."""
    return F.coalesce(mjd_, mjd_obs, jd - 2400000.5, mjd(date_obs))


def local_to_utc(ts: Column, zone: str = "America/Santiago") -> Column:
    return F.to_utc_timestamp(ts, zone)


def angle(text: Column, hours: bool = False) -> Column:
    """Degrees from `d`, `d:m:s` or `d m s` text (hours: times 15); null if it is not an angle."""
    parts = F.split(F.regexp_replace(F.trim(text), r"[:\shdm°'\"s]+", ":"), ":")
    d, m, s = (F.coalesce(F.try_element_at(parts, F.lit(i)).try_cast("double"), F.lit(0.0) if i > 1 else F.lit(None).cast("double")) for i in (1, 2, 3))
    sign = F.when(F.startswith(F.trim(text), F.lit("-")), -1.0).otherwise(1.0)
    whole = F.abs(d) + m / 60 + s / 3600
    return sign * whole * (F.when(F.size(parts) > 1, 15.0).otherwise(1.0) if hours else 1.0)


def classify_parameter(p: Column, unit: str = UNIT) -> Column:
    """date, unit, filter, type or target of a free parameter."""
    return (F.when(p.rlike(r"^\d{4}-\d{2}-\d{2}$|^\d{8}$"), "date").when(p.rlike(f"^{unit}$"), "unit").when(p.isin(*FILTERS) | p.rlike(r"^m\d{3}w?$"), "filter")
            .when(F.lower(p).isin(*TYPE_ALIASES), "type").otherwise("target"))


def is_tile(name: Column) -> Column:
    return name.rlike(r"^T\d{5}")


def find_tile(name: Column) -> Column:
    """The first tile name anywhere; null if none."""
    found = F.regexp_extract(name, r"T\d{5}", 0)
    return F.nullif(found, F.lit(""))


def batch_key(path: Column) -> Column:
    """Directory name without .tar and a trailing date and time."""
    return F.regexp_replace(F.regexp_replace(path, r"\.tar$", ""), r"_\d{8}_\d{6}$", "")


def batch_family(key: Column) -> Column:
    return F.regexp_replace(key, r"_ToO", "")


def format_exptime(t: Column) -> Column:
    return F.concat(F.format_string("%.0f", t.cast("double")), F.lit("s"))


def strip_number(text: Column, prefix: str = "", suffix: str = "") -> Column:
    """The number between a fixed prefix and suffix."""
    return F.regexp_extract(text, f"^{prefix}([0-9.]+){suffix}$", 1).try_cast("double")


def raw_name(unit: Column, ts: Column, obj: Column, filt: Column, binning: Column, exptime: Column) -> Column:
    return F.concat_ws("_", unit, compact_time(ts), obj, filt, F.concat(binning.cast("string"), F.lit("x"), binning.cast("string")), format_exptime(exptime))


def processed_name(obj: Column, filt: Column, unit: Column, ts: Column, exptime: Column) -> Column:
    return F.concat_ws("_", obj, filt, unit, compact_time(ts), format_exptime(exptime))


def parse_raw(name: Column) -> dict[str, Column]:
    """Parts of unit_date_time_object_filter_bin_exptime; the object may hold underscores."""
    p = F.split(F.regexp_replace(name, r"\.fits$", ""), "_")
    n = F.size(p)
    return {"unit": p[0], "ts": F.try_to_timestamp(F.concat(F.get(p, 1), F.get(p, 2)), F.lit("yyyyMMddHHmmss")), "obj": F.array_join(F.slice(p, 4, F.greatest(n - 6, F.lit(0))), "_"), "filt": F.try_element_at(p, F.lit(-3)), "binning": F.regexp_extract(F.try_element_at(p, F.lit(-2)), r"^(\d+)x", 1).try_cast("int"), "exptime": F.regexp_extract(F.try_element_at(p, F.lit(-1)), r"^(\d+)s", 1).try_cast("int")}


def type_tuple(name: Column, unit: str = UNIT) -> dict[str, Column]:
    """The five components of a file's type from its name; unit: pattern of the names of instruments."""
    base = F.lower(name)
    raw = name.rlike(f"^{unit}_")
    master = base.rlike(r"^(bias|dark|flat)")
    return {
        "stage": F.when(raw, "raw").when(master, "master").otherwise("calibrated"),
        "kind": F.when(base.rlike(r"(^|_)bias"), "bias").when(base.rlike(r"(^|_)dark"), "dark").when(base.rlike(r"(^|_)flat"), "flat").otherwise("science"),
        "stack": F.when(base.contains("coadd"), "coadded").otherwise("single"), "difference": base.contains("diff"),
        "product": F.when(base.rlike(r"weight\.fits$"), "weight").when(base.rlike(r"_cat\.fits$"), "catalog").when(base.rlike(r"mask\.fits$"), "mask").otherwise("image"),
    }


def collapse(values: Column, force: bool = False) -> Column:
    """The one value of an array whose values are all equal; else null, or with force the first."""
    one = F.size(F.array_distinct(values)) == 1
    return F.when(one | F.lit(force), F.try_element_at(values, F.lit(1)))


def flag_label(bits: Column) -> Column:
    """Names of the set bits, joined."""
    return F.array_join(F.filter(F.array(*[F.when(bits.bitwiseAND(F.lit(b)) != 0, F.lit(t)) for b, t in FLAG_BITS.items()]), lambda x: x.isNotNull()), ", ")


def flag_spec(bits: Column) -> Column:
    """Six binary digits."""
    return F.lpad(F.bin(bits.cast("long")), 6, "0")


def json_list(text: Column) -> Column:
    """Strings of a JSON list; null if it is not one."""
    return F.from_json(text, "array<string>")


def saturation(bitpix: Column, bias: Column, dark: Column, flat: Column) -> Column:
    """(2 ** bitpix - 1 - bias - dark) / flat, or 0.9 of the range where a part is missing."""
    top = F.pow(F.lit(2.0), bitpix) - 1
    return F.coalesce((top - bias - dark) / flat, 0.9 * top)


def asinh_stretch(v: Column, sky: Column | float, noise: Column | float, softening: float = 10.0) -> Column:
    return F.asinh((v - sky) / (softening * noise)) * softening


def clipped_stretch(v: Column, sky: float, noise: float, top: Column, k_soft: float = 3.0, low: float = -1.0) -> Column:
    """To 0..1: v less the sky, held between `low` noises and the value `top`, by arcsinh with a softening of k_soft noises."""
    held = F.least(F.greatest(v - sky, F.lit(low * noise)), top - sky)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.asinh(held / (k_soft * noise)) / F.asinh((top - sky) / (k_soft * noise))))


def merge_comment(old: Column, new: Column, overwrite: bool = False) -> Column:
    """An existing comment stays unless it is empty or is overwritten."""
    empty = old.isNull() | (F.trim(old) == "")
    return F.when(empty | F.lit(overwrite), F.coalesce(new, old)).otherwise(old)
