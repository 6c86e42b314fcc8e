"""Document keys and served text fields."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: longest text kept in a case-exact field.
IGNORE_ABOVE = 256


def vote_doc_id() -> Column:
    """Fixed form. Hash of party, province and region. ``concat_ws`` skips a NULL party, so blank
    votes of one province share the key of province and region alone."""
    return F.sha2(F.concat_ws("||", "political_party", "province_name", "autonomic_region_name"), 256)


def seat_key(*fields: str) -> Column:
    """Hash of region, province and party: unlike the readable key, one for each seat count.

    A NULL is told from every text, and no text can pass for two fields.
    """
    parts = [F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit("-")) for name in fields]
    return F.sha2(F.to_json(F.array(*parts)).cast("binary"), 256)


def seat_doc_id() -> Column:
    """Readable key of a seat message: province and party. Fixed form; see ``seat_key``."""
    return F.concat_ws("_", "province_name", "political_party_norm")


def keyword(column: Column, ignore_above: int = IGNORE_ABOVE) -> Column:
    """Case-exact value of a text field; longer values are not kept."""
    return F.when(F.length(column) <= ignore_above, column)
