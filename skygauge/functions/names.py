"""Governorate names: aliases of the batch files and partitions of the stream."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from skygauge import lookups as L


def _literal_map(pairs) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs for x in pair])


def cleaned(city: Column | str) -> Column:
    return F.upper(F.trim(city))


def is_dropped(city: Column | str, source: str) -> Column:
    """True for names the source drops."""
    dropped = [raw for raw, to in L.CITY_ALIASES[source].items() if to is None]
    return cleaned(city).isin(*dropped) if dropped else F.lit(False)


def canonical_name(city: Column | str, source: str) -> Column:
    """Stored governorate of a raw city; NULL for names the source drops.

    A literal map keeps this a projection: no join, and unknown names pass through.
    """
    name = cleaned(city)
    renamed = _literal_map((raw, to) for raw, to in L.CITY_ALIASES[source].items() if to is not None)
    result = F.coalesce(F.try_element_at(renamed, name), name)
    drops = None in L.CITY_ALIASES[source].values()
    return F.when(~is_dropped(city, source), result) if drops else result


def batch_spelling(stream_name: Column | str) -> Column:
    """Name of a stream governorate as the batch tables spell it."""
    name = cleaned(stream_name)
    return F.coalesce(F.try_element_at(_literal_map(L.STREAM_TO_BATCH_NAMES.items()), name), name)


def partition_of(governorate: Column | str, strict: bool = False) -> Column:
    """Stream partition of a governorate; unknown names give NULL, or an error if strict."""
    governorate = F.col(governorate) if isinstance(governorate, str) else governorate
    lookup = _literal_map(
        (name, number) for number, names in L.STREAM_PARTITIONS.items() for name in names)
    found = F.try_element_at(lookup, governorate)
    if not strict:
        return found
    return F.coalesce(found, F.raise_error(F.concat(F.lit("Unknown governorate: "),
                                                    F.coalesce(governorate, F.lit("NULL")))).cast("int"))
