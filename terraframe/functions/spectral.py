"""Column functions on reflectances: indices, scaling, packing, coding. Missing is NULL throughout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Index pairs (high, low), ratio pairs, caps, band aliases and area constants.
NORMALISED = {"GNDVI": ("B8", "B3"), "NDRE": ("B8", "B5"), "NDWI": ("B3", "B8"), "NDVI_CALC": ("B8", "B4"), "NDMI": ("B8", "B11"), "NBR": ("B8", "B12"), "MNDWI": ("B3", "B11")}
RATIOS = {"R43": ("B4", "B3"), "R84": ("B8", "B4"), "R85": ("B8", "B5"), "R28": ("B2", "B8"), "R1112": ("B11", "B12")}
CAPS = {"B2": 3976, "B3": 3940, "B4": 3000, "B5": 4345, "B8": 6000, "NDVI": 9571}
SQ_M_PER_ACRE = 4046.8564224
ACRES_PER_SQ_M = 0.000247105
# Band: asset names of the two catalogs, further names; index: (high, low).
SENTINEL2 = {
    "coastal": ("B01", "coastal", ("b1", "aerosol")),
    "blue": ("B02", "blue", ("b2",)),
    "green": ("B03", "green", ("b3",)),
    "red": ("B04", "red", ("b4",)),
    "rededge1": ("B05", "rededge1", ("b5", "rededge")),
    "rededge2": ("B06", "rededge2", ("b6",)),
    "rededge3": ("B07", "rededge3", ("b7",)),
    "nir": ("B08", "nir", ("b8",)),
    "nir08": ("B8A", "nir08", ("narrownir",)),
    "nir09": ("B09", "nir09", ("b9", "watervapour", "watervapor")),
    "swir16": ("B11", "swir16", ("swir1",)),
    "swir22": ("B12", "swir22", ("swir2",)),
}
INDICES = {"ndvi": ("nir", "red"), "gndvi": ("nir", "green"), "ndre": ("nir", "rededge1"), "ndwi": ("green", "nir"), "mndwi": ("green", "swir16"), "ndmi": ("nir", "swir16"), "nbr": ("nir", "swir22")}
PROVIDERS = ("mpc", "earthsearch")
SOURCES = ("B2", "B3", "B4", "B5", "B8", "NDVI", "B11", "B12")


def safe_divide(n: Column, d: Column) -> Column:
    """n / d, NULL where the divisor is 0."""
    return F.try_divide(n.cast("double"), d.cast("double"))


def feature(name: str, bands: list[str]) -> Column:
    """A feature by name over source bands: a band itself, a normalised difference or a ratio (x 10000)."""
    if name in bands:
        return F.col(name)
    pair = NORMALISED.get(name) or RATIOS.get(name)
    if pair is None:
        raise ValueError(f"unknown feature {name}")
    if missing := [b for b in pair if b not in bands]:
        raise ValueError(f"{name} needs {missing}")
    a, b = (F.col(x).cast("double") for x in pair)
    return safe_divide(a - b, a + b) * 10000 if name in NORMALISED else safe_divide(a, b) * 10000


def describe(names: list[str]) -> dict[str, str]:
    """Definitions of features as text."""
    text = {n: f"({a} - {b}) / ({a} + {b}) * 10000" for n, (a, b) in NORMALISED.items()} | {n: f"{a} / {b} * 10000" for n, (a, b) in RATIOS.items()}
    return {n: text.get(n, n) for n in names}


def ndvi(nir: Column, red: Column) -> Column:
    """NDVI where nir + red is positive."""
    return F.when(nir + red > 0, (nir - red).cast("double") / (nir + red))


def landsat_ndvi(nir: Column, red: Column) -> Column:
    """NDVI of Landsat collection-2 counts: both positive, scaled, nonzero sum."""
    scale = lambda x: x * 0.0000275 - 0.2
    return F.when((nir > 0) & (red > 0), safe_divide(scale(nir) - scale(red), scale(nir) + scale(red)))


def offset_clip(x: Column, offset: Column | float) -> Column:
    """x - offset, at least 0; missing stays missing."""
    return F.when(x.isNotNull(), F.greatest(x - offset, F.lit(0)))


def pack_uint16(x: Column) -> Column:
    """Truncate into 0..65535; missing becomes 0."""
    return F.least(F.lit(65535), F.greatest(F.lit(0), F.coalesce(x, F.lit(0)))).cast("int")


def gain_offset(x: Column, gain: Column, offset: Column) -> Column:
    return F.when(x.isNotNull(), F.greatest(x * gain + offset, F.lit(0.0)))


def decibel(power: Column) -> Column:
    return F.when(power > 0, 10 * F.log10(power))


def snap(x: Column, step: float) -> Column:
    return F.floor(x / F.lit(step)) * F.lit(step)


def pixel_id(row: Column, col: Column, width: int) -> Column:
    return row.cast("bigint") * width + col


def pixel_row_col(pid: Column, width: int) -> tuple[Column, Column]:
    return F.floor(pid / width).cast("bigint"), pid % width


def acres(pixels: Column, area: float = 100.0) -> Column:
    return pixels * F.lit(area) / F.lit(SQ_M_PER_ACRE)


def classify(prob: Column, threshold: float, positive: int = 1, background: int = 4) -> Column:
    """Class by threshold (inclusive); NULL where there is no probability."""
    return F.when(prob.isNull(), None).when(prob >= threshold, positive).otherwise(background)


def remap(x: Column, table: dict, strict: bool = True) -> Column:
    """Map values by a table; an unmapped value is an error unless not ``strict``."""
    mapped = F.element_at(F.create_map(*[F.lit(v) for kv in table.items() for v in kv]), x)
    return F.when(x.isNotNull() & mapped.isNull(), F.raise_error(F.concat(F.lit("unmapped value "), x.cast("string")))).otherwise(mapped) if strict else mapped


def normalise_band(name: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(name)), "[-_ ]", "")


def _key(name: str) -> str:
    return name.strip().lower().translate(str.maketrans("", "", "-_ "))


def resolve_bands(bands: list[str]) -> list[str]:
    """Canonical band names in order without repeats; unknown or no bands are an error."""
    known = {k: n for n, (code, asset, more) in SENTINEL2.items() for k in (n, code.lower(), asset, *more)}
    out: list[str] = []
    for b in bands:
        name = known.get(_key(b))
        if name is None:
            raise ValueError(f"unknown band {b!r}")
        if name not in out:
            out.append(name)
    if not out:
        raise ValueError("no bands")
    return out


def split_bands(bands: list[str]) -> tuple[list[str], list[str], list[str]]:
    """(bands to read, indices to compute, all in the order asked for); an index brings its inputs along."""
    order = list(dict.fromkeys(_key(b) if _key(b) in INDICES else resolve_bands([b])[0] for b in bands))
    if not order:
        raise ValueError("no bands")
    indices = [b for b in order if b in INDICES]
    inputs = [x for i in indices for x in INDICES[i]]
    return list(dict.fromkeys([b for b in order if b not in INDICES] + inputs)), indices, order


def provider_assets(provider: str, bands: list[str]) -> list[str]:
    """A catalog's asset names of canonical bands, in order."""
    return [SENTINEL2[b][PROVIDERS.index(provider)] for b in bands]


def source_columns(columns: list[str], wanted: list[str] | None = None) -> list[str]:
    """Bands to take from a table: those named, or every known one that it has; an error if any or all lack."""
    found = [c for c in (SOURCES if wanted is None else wanted) if c in columns]
    if not found or (wanted is not None and len(found) < len(wanted)):
        raise ValueError(f"missing bands {sorted(set(wanted or SOURCES) - set(columns))}")
    return found


def feature_matrix(names: list[str], bands: list[str]) -> Column:
    """Array of the named features in the caller's order."""
    if not names:
        raise ValueError("no features")
    return F.array(*[feature(n, bands).cast("double") for n in names])


def within_caps(bands: list[str], caps: dict[str, int] = CAPS) -> Column:
    """Row kept iff every band present is at most its cap."""
    return reduce(lambda a, b: a & b, [F.col(b) <= caps[b] for b in bands if b in caps], F.lit(True))


def scl_keep(scl: Column) -> Column:
    """Composite mask: classes under 8 but cloud shadow (3)."""
    return (scl < 8) & (scl != 3)


def scl_usable(scl: Column, mask_clouds: bool = True) -> Column:
    """Static-image mask."""
    return ~scl.isin(0, 1, 3, 8, 9, 10, 11) if mask_clouds else ~scl.isin(0, 1)


def deviation_pct(x: Column, reference: Column) -> Column:
    return (x - reference) / reference * 100


def confusion_scores(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    """Precision, recall and F1, 0 where a denominator is 0."""
    p = F.coalesce(safe_divide(tp, tp + fp), F.lit(0.0))
    r = F.coalesce(safe_divide(tp, tp + fn), F.lit(0.0))
    return p, r, F.coalesce(safe_divide(2 * p * r, p + r), F.lit(0.0))
