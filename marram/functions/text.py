"""Text rules: switches, parameter names, storage addresses, versions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words accepted as a switch, and the two address formats.
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")
STORE_PREFIX = "azureml://datastores/"
STORE_PATH_MARK = "/paths/"
ABFSS_HOST_SUFFIX = ".dfs.core.windows.net"


def text_to_bool(text: Column, strict: bool = False) -> Column:
    """TRUE, FALSE, or NULL when the text is neither; in strict mode such a text fails the job."""
    word = F.lower(F.trim(text))
    switch = F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))
    if not strict:
        return switch
    allowed = ", ".join((*TRUE_WORDS, *FALSE_WORDS))
    return switch.otherwise(F.raise_error(F.concat(F.lit(f"expected one of {allowed}; got "), text)).cast("boolean"))


def or_default(text: Column, default: str) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def strip_prefix(text: Column, prefix: str = "model__") -> Column:
    return F.when(
        F.startswith(text, F.lit(prefix)), F.substr(text, F.lit(len(prefix) + 1))
    ).otherwise(text)


def parse_store_uri(uri: Column) -> Column:
    """struct(store, path), NULL unless the address has the prefix and a path mark.

    The first mark separates the two, so a path may hold further marks.
    """
    rest = F.substr(uri, F.lit(len(STORE_PREFIX) + 1))
    parts = F.split(rest, STORE_PATH_MARK, 2)
    matches = F.startswith(uri, F.lit(STORE_PREFIX)) & (F.size(parts) == 2)
    return F.when(matches, F.struct(parts[0].alias("store"), parts[1].alias("path")))


def abfss_uri(account: Column, filesystem: Column, path: Column) -> Column:
    return F.concat(
        F.lit("abfss://"), filesystem, F.lit("@"), account, F.lit(ABFSS_HOST_SUFFIX + "/"),
        F.ltrim(path, F.lit("/")),
    )
