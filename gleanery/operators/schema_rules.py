"""Schema errors of loosely typed question records; errors are rows, not exceptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.sources.stored import numbered, spread

# The record's contract, by key.
REQUIRED = {"id": ("str",), "text": ("str",), "options": ("dict",), "answer": ("str",), "explanation": ("str", "dict"), "year": ("str",), "chapter": ("str",), "class": ("str",), "images": ("list",), "tables": ("list",)}
EXTRACTION = {"source": "str", "status": "str", "imageTokenCount": "int", "nonEmptyOptionCount": "int"}
LABELS = "ABCD"
ERROR = "struct<field:string,type:string,expected:string,actual:string>"


TYPE_NAMES = {"OBJECT": "dict", "ARRAY": "list", "STRING": "str", "BIGINT": "int", "BOOLEAN": "bool", "VOID": "NoneType"}


def type_name(v: Column) -> Column:
    """The type's name as Python has it."""
    names = F.create_map(*(F.lit(x) for pair in TYPE_NAMES.items() for x in pair))
    return F.coalesce(names[F.substring_index(F.schema_of_variant(v), "<", 1)], F.lit("float"))


def _types(v: Column, path: str = "$") -> Column:
    """map<string,string> of an object's keys and their types; empty for what is no object."""
    fields = F.try_variant_get(v, path, "map<string,variant>")
    return F.coalesce(F.transform_values(fields, lambda _, x: type_name(x)), F.create_map().cast("map<string,string>"))


def _error(field: str, kind: str, expected: str | None = None, actual: Column | None = None) -> Column:
    return F.struct(F.lit(field).alias("field"), F.lit(kind).alias("type"), F.lit(expected).cast("string").alias("expected"), (F.lit(None).cast("string") if actual is None else actual).alias("actual"))


INNER = {"options": (LABELS, "missing_option", "wrong_option_type"), "explanation": (("correct", "others"), "missing_explanation_key", "wrong_explanation_type")}


def question_errors(v: Column) -> Column:
    """array of errors of one record (a variant), in the order of the rules. The record is taken apart once; the
    rules see the types of its fields."""
    of_list = F.exists(F.try_variant_get(v, "$.parserWarnings", "array<variant>"), lambda x: type_name(x) != "str")
    own = F.struct(type_name(v).alias("self"), _types(v).alias("top"), *(_types(v, f"$.{k}").alias(k) for k in (*INNER, "optionExtraction")), of_list.alias("of_list"))
    return F.transform(F.array(own), _broken_rules)[0]


def _broken_rules(own: Column) -> Column:
    top = own["top"]
    kind = lambda k: top[k]
    has = lambda k: kind(k).isNotNull()
    out = []
    for k, types in REQUIRED.items():
        out.append(F.when(~has(k), _error(k, "missing_key")).when(~kind(k).isin(*types), _error(k, "wrong_type", "|".join(types), kind(k))))
    # A record without options or explanation lacks each of their keys, too.
    for k, (labels, missing, wrong) in INNER.items():
        is_dict = ~has(k) | (kind(k) == "dict")
        for x in labels:
            there = own[k][x]
            out.append(F.when(is_dict & there.isNull(), _error(f"{k}.{x}", missing)).when(is_dict & (there != "str"), _error(f"{k}.{x}", wrong, "str", there)))
        if k == "explanation":
            out.append(F.when(has(k) & ~kind(k).isin("str", "dict"), _error(k, wrong, "str|dict", kind(k))))
    oe = "optionExtraction"
    out.append(F.when(has(oe) & (kind(oe) != "dict"), _error(oe, "wrong_type", "dict", kind(oe))))
    for x, t in EXTRACTION.items():
        actual = own[oe][x]
        out.append(F.when((kind(oe) == "dict") & actual.isNull(), _error(f"{oe}.{x}", "missing_key")).when(~actual.isin(t, *(["bool"] if t == "int" else [])), _error(f"{oe}.{x}", "wrong_type", t, actual)))
    pw = "parserWarnings"
    out.append(F.when(has(pw) & (kind(pw) != "list"), _error(pw, "wrong_type", "list", kind(pw))))
    out.append(F.when((kind(pw) == "list") & own["of_list"], _error(pw, "wrong_warning_type", "str")))
    return F.when(own["self"] != "dict", F.array(_error("question", "question_not_object", "dict", own["self"]))).otherwise(F.filter(F.array(*out), lambda e: e.isNotNull()))


def record_errors(records: DataFrame, json: str = "json") -> DataFrame:
    """The records' columns and n_error (in order), field, type, expected, actual: a row an error."""
    rows = numbered(spread(records), question_errors(F.try_parse_json(json)), "n_error", "e")
    return rows.select(*records.columns, "n_error", "e.*")


def chapter_errors(chapters: DataFrame, root: str = "root") -> DataFrame:
    """The chapters' other columns and index, n_error, field, type, expected, actual: errors of
    chapter files given as variants. A root that is no list is one error, without an index."""
    keep = [c for c in chapters.columns if c != root]
    return records_errors(numbered(chapters, records_of(F.col(root)), "index", "r").select(*keep, "index", "r.*"))


def records_of(root: Column) -> Column:
    """array of struct<v: variant, whole: boolean>: a chapter file's records; a root that is no list is a whole one."""
    items = F.transform(F.try_variant_get(root, "$", "array<variant>"), lambda x: F.struct(x.alias("v"), F.lit(False).alias("whole")))
    return F.coalesce(items, F.array(F.struct(root.alias("v"), F.lit(True).alias("whole"))))


def record_texts(root: Column, text: bool) -> Column:
    """array of a chapter file's records as JSON texts; null for a root that is no list. root: a variant, or the file's text.
    Objects keep their text as it is."""
    told = root if text else F.to_json(root)
    items, kinds = F.from_json(told, "array<string>"), F.from_json(told, "array<variant>")
    return F.zip_with(items, kinds, lambda t, v: F.when(F.try_variant_get(v, "$", "struct<>").isNotNull(), t).otherwise(F.to_json(v)))


def records_errors(records: DataFrame) -> DataFrame:
    """As chapter_errors, of rows with index, v and whole."""
    keep = [c for c in records.columns if c not in ("index", "v", "whole")]
    odd = F.array(_error("root", "root_not_list"))
    found = numbered(records, F.when(F.col("whole"), odd).otherwise(question_errors(F.col("v"))), "n_error", "e")
    return found.select(*keep, F.when(~F.col("whole"), F.col("index")).alias("index"), "n_error", "e.*")
