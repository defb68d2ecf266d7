"""Exporting search results as csv, json, xml or raw event text.

Nothing is written for an empty result (the caller gets ``None``), as a search
with zero results returns before any output is opened. Timestamps are written
with microseconds so the files read back equal to the source rows.

Text columns keep every value. In csv, text that is any number of backslashes and ``N`` gets one
backslash more, so that it isn't the null mark. In xml, characters that XML 1.0 can't hold or
changes (controls but tab and line feed, U+FFFE, U+FFFF) are written as ``\\uXXXX``, and the
backslash of text that looks like this, or like the null mark, as ``\\u005c``. :func:`read_export`
undoes both; other text is written as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# The output modes and the row tag of xml output.
MODES = ("csv", "json", "xml", "raw")
XML_ROW_TAG = "result"
# Written for null in csv and xml (as databases do).
NULL_MARK = "\\N"
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _options(mode: str) -> dict:
    common = {"timestampNTZFormat": TS_NTZ_FORMAT, "timestampFormat": TS_FORMAT}
    if mode == "csv":
        # text keeps its spaces, and null, empty and any other text read back apart
        return {**common, "header": "true", "escape": '"', "quoteAll": "true", "nullValue": NULL_MARK, "emptyValue": "",
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    if mode == "json":
        return {**common, "ignoreNullFields": "false"}
    if mode == "xml":
        return {**common, "rowTag": XML_ROW_TAG, "rootTag": "results", "nullValue": NULL_MARK,
                "ignoreSurroundingSpaces": "false"}
    return {}


#: What XML 1.0 can't hold, or reads back changed.
XML_LACKS = [*map(chr, range(9)), *map(chr, range(11, 32)), "\ufffe", "\uffff"]


def _csv_text(c: Column) -> Column:
    return F.when(c.rlike(r"^\\+N\z"), F.concat(F.lit("\\"), c)).otherwise(c)


def _from_csv(c: Column) -> Column:
    return F.when(c.rlike(r"^\\{2,}N\z"), F.substring(c, 2, 2_147_483_647)).otherwise(c)


def _xml_text(c: Column) -> Column:
    out = F.replace(c, F.lit("\\u"), F.lit("\\u005cu"))
    out = F.when(out == NULL_MARK, F.lit("\\u005cN")).otherwise(out)
    odd = out
    for ch in XML_LACKS:
        odd = F.replace(odd, F.lit(ch), F.lit(f"\\u{ord(ch):04x}"))
    return F.when(out.rlike(r"[\x00-\x08\x0B-\x1F\x{FFFE}\x{FFFF}]"), odd).otherwise(out)


def _from_xml(c: Column) -> Column:
    # one pass from the left: text between escapes is left alone
    parts = F.split(c, r"\\u(?=[0-9a-f]{4})", -1)
    text = lambda p: F.concat(F.chr(F.conv(F.substring(p, 1, 4), 16, 10).cast("int")), F.substring(p, 5, 2_147_483_647))
    wide = lambda p: F.decode(F.unhex(F.substring(p, 1, 4)), "UTF-16BE")
    piece = lambda p: F.when(F.substring(p, 1, 2) == "00", text(p)).otherwise(F.concat(wide(p), F.substring(p, 5, 2_147_483_647)))
    undone = F.concat(F.get(parts, 0), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), piece), ""))
    return F.when(F.instr(c, "\\u") > 0, undone).otherwise(c)


_WRITE, _READ = {"csv": _csv_text, "xml": _xml_text}, {"csv": _from_csv, "xml": _from_xml}


def _texts(df: DataFrame, how) -> DataFrame:
    """``df`` with ``how`` applied to its text columns."""
    if how is None:
        return df
    return df.select(*[how(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`") for f in df.schema])


def export_results(df: DataFrame, path: str, mode: str = "csv", raw: str = "raw",
                   check_empty: bool = True, write_mode: str = "overwrite") -> str | None:
    """Write ``df`` to ``path`` in ``mode``; ``None`` (nothing written) when empty."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if check_empty and df.isEmpty():
        return None
    if mode == "raw":
        df.select(raw).write.mode(write_mode).text(path)
    else:
        _texts(df, _WRITE.get(mode)).write.mode(write_mode).options(**_options(mode)).format(mode).save(path)
    return path


def read_export(spark: SparkSession, path: str, mode: str, schema: StructType | None = None,
                raw: str = "raw") -> DataFrame:
    """Read an export back, with the original schema when given."""
    if mode == "raw":
        return spark.read.text(path).withColumnRenamed("value", raw)
    options = _options(mode)
    if mode == "csv":
        options["multiLine"] = "true"  # quoted values may hold line breaks
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return _texts(reader.format(mode).load(path), _READ.get(mode))
