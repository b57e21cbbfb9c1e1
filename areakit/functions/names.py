"""Area-name spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters, the plain letters they become, and the
# interpunct, which separates words.
ACCENTED = "àáâäèéêëìíîïòóôöùúûüçñ·"
PLAIN = "aaaaeeeeiiiioooouuuucn "


def normalize_name(name: Column) -> Column:
    """Lower case, no accents, every run of other characters as one space."""
    plain = F.translate(F.lower(name), ACCENTED, PLAIN)
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))


def strip_quotes(name: Column) -> Column:
    """Drop the literal quotes a name is wrapped in, if it is."""
    wrapped = (F.length(name) >= 2) & name.startswith('"') & name.endswith('"')
    return F.when(wrapped, F.substring(name, F.lit(2), F.length(name) - 2)).otherwise(name)
