"""Text and timestamp expressions whose exact rules matter to a load."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text form of a timestamp mark (microseconds) and of the
# style the source accepts in a filter (milliseconds).
MARK_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
STYLE_121 = "yyyy-MM-dd HH:mm:ss.SSS"

# Fixed value: what a connection label starts with.
LABEL_PREFIX = "SQL_"


def mark_text(ts: Column) -> Column:
    """Sortable text of a timestamp, to the microsecond."""
    return F.date_format(ts, MARK_FORMAT)


def style_121(text: Column) -> Column:
    """Text with milliseconds to a zone-less timestamp."""
    return F.to_timestamp_ntz(text, F.lit(STYLE_121))


def prefix_before(text: Column, delimiter: str) -> Column:
    """What precedes the first delimiter; an empty string when there is none or the text is NULL."""
    return F.when(F.instr(text, delimiter) > 0, F.substring_index(text, delimiter, 1)).otherwise(F.lit(""))


def text_length(text: Column) -> Column:
    """Characters without trailing blanks, which the source database's LEN does not count either."""
    return F.length(F.rtrim(text))


def like_prefix(text: Column, prefix: str) -> Column:
    """LIKE 'prefix%' with the wildcards inside ``prefix`` taken literally."""
    escaped = prefix.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return text.like(escaped + "%")


def timestamp_literal(text: str) -> Column:
    """A constant that folds to a literal, so a comparison with it reaches the scan."""
    return F.lit(text).cast("timestamp_ntz")


def default_fill(value: Column, default: Column) -> Column:
    return F.coalesce(value, default)


def server_label(server: Column, database: Column) -> Column:
    """Connection label of a server and a database; NULL if either part is NULL."""
    return F.concat(F.lit(LABEL_PREFIX), prefix_before(server, "\\"), F.lit("_"), database)
