"""Contract check of raw payload text against a declared schema.

A payload is parsed once into a VARIANT and the schema is turned into one
expression that lists what is wrong with it, so the check is a single narrow
projection: no UDF, no shuffle. The check never blocks; a violating payload is
still kept unless the caller asks for :func:`conforming` rows only.

Most payloads have nothing wrong with them. Without arrays in the schema that shows in
the text of their shape, which is held against one pattern; only others are taken apart.

A contract is open unless said otherwise: further keys are reported as drift, but set no
payload aside. With ``closed`` they do. A whole number is one written without a decimal
point, as the reader has it: ``5.0`` is no value of an integer field.

Kinds: ``corrupt`` (not a JSON document), ``missing`` (a required field is
absent), ``wrong_type``, ``unknown_key``.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VIOLATION = T.ArrayType(
    T.StructType([T.StructField("path", T.StringType()), T.StructField("kind", T.StringType())])
)

# Kinds of JSON value a declared leaf type accepts.
ACCEPTED = {
    T.StringType: ("STRING",),
    T.BooleanType: ("BOOLEAN",),
    T.IntegerType: ("BIGINT",),
    T.LongType: ("BIGINT",),
    T.DoubleType: ("BIGINT", "DOUBLE"),
    T.MapType: ("OBJECT",),
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _found(names: Column, kind: str, prefix: Column) -> Column:
    return F.transform(
        names, lambda n: F.struct(F.concat(prefix, n).alias("path"), F.lit(kind).alias("kind"))
    )


def _one(path: Column, kind: str) -> Column:
    return F.array(F.struct(path.alias("path"), F.lit(kind).alias("kind")))


def _none() -> Column:
    return F.array().cast(VIOLATION)


def _kind(value: Column) -> Column:
    """STRING, BOOLEAN, BIGINT, DOUBLE, VOID, OBJECT or ARRAY; ``1.0`` is a DOUBLE."""
    return _let(
        F.schema_of_variant(value),
        lambda name: F.when(name.startswith("DECIMAL") | (name == "FLOAT"), "DOUBLE")
        .otherwise(F.substring_index(name, "<", 1)),
    )


def _check(value: Column, dtype: T.DataType, path: Column) -> Column:
    """Violations of a struct or an array that is present and not null."""
    if isinstance(dtype, T.StructType):
        parts = F.try_variant_get(value, "$", "map<string,variant>")
        inside = lambda m: _check_entries(m, dtype, F.concat(path, F.lit(".")))
    else:
        parts = F.try_variant_get(value, "$", "array<variant>")
        item_path = F.concat(path, F.lit("[]"))
        inside = lambda items: F.array_distinct(
            F.flatten(F.transform(items, lambda v: _check(v, dtype.elementType, item_path)))
        )
    wrong = _one(path, "wrong_type")
    return _let(parts, lambda p: F.when(p.isNull(), wrong).otherwise(inside(p)))


def _check_entries(entries: Column, schema: T.StructType, prefix: Column) -> Column:
    """Violations of an object, given as a map from key to value."""
    nested = [f for f in schema if isinstance(f.dataType, (T.StructType, T.ArrayType))]
    leaves = [f for f in schema if f not in nested]
    required = [F.lit(f.name) for f in schema if not f.nullable]
    names = [F.lit(n) for n in schema.names]
    text_array = lambda items: F.array(*items).cast("array<string>")

    present = F.map_keys(entries)
    checks = [_found(F.array_except(present, text_array(names)), "unknown_key", prefix)]
    if required:
        absent = F.array_except(text_array(required), present)
        checks.append(_found(absent, "missing", prefix))
    if leaves:
        accepted = F.create_map(
            *[
                part
                for f in leaves
                for part in (
                    F.lit(f.name),
                    text_array(
                        F.lit(k) for k in ACCEPTED[type(f.dataType)] + (("VOID",) if f.nullable else ())
                    ),
                )
            ]
        )
        misfits = F.map_filter(
            entries,
            lambda k, v: ~F.coalesce(
                F.array_contains(F.try_element_at(accepted, k), _kind(v)), F.lit(True)
            ),
        )
        checks.append(_found(F.map_keys(misfits), "wrong_type", prefix))
    checks += [_check_child(entries, field, prefix) for field in nested]
    return F.concat(*checks)


def _check_child(entries: Column, field: T.StructField, prefix: Column) -> Column:
    """Violations below a struct or array field; its absence is reported elsewhere."""
    path = F.concat(prefix, F.lit(field.name))

    def below(child: Column) -> Column:
        skipped = child.isNull() | (F.is_variant_null(child) if field.nullable else F.lit(False))
        return F.when(skipped, _none()).otherwise(_check(child, field.dataType, path))

    return _let(F.try_element_at(entries, F.lit(field.name)), below)


def _quoted(name: str) -> str:
    """A name as a shape has it: in backticks, unless it is a plain identifier."""
    return name if re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", name) else f"`{name.replace('`', '``')}`"


def _clean_shape(dtype: T.DataType, nullable: bool) -> str | None:
    """Pattern of the shapes in which nothing is wrong; None if shapes do not tell.

    An array's shape merges its elements and hides which of them lack a key. The keys of an
    object are in the order of their UTF-8 bytes.
    """
    if isinstance(dtype, T.StructType):
        parts = []
        for field in sorted(dtype, key=lambda f: f.name.encode()):
            inside = _clean_shape(field.dataType, field.nullable)
            if inside is None:
                return None
            entry = rf"{_literal(_quoted(field.name))}: {inside}(?:, |(?=>))"
            parts.append(f"(?:{entry})?+" if field.nullable else entry)
        kinds = [f"OBJECT<{''.join(parts)}>"]
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        return None
    else:
        numbers = {"DOUBLE": r"(?:DOUBLE|FLOAT|DECIMAL\([0-9]+,[0-9]+\))"}
        kinds = [numbers.get(kind, kind) for kind in ACCEPTED[type(dtype)]]
    return f"(?:{'|'.join([*kinds, 'VOID'] if nullable else kinds)})"


def _literal(text: str) -> str:
    """A text as a pattern of just this text."""
    return re.sub(r"([^A-Za-z0-9_`])", lambda m: rf"\x{{{ord(m[1]):X}}}", text)


def violations(document: Column, schema: T.StructType) -> Column:
    """Array of ``(path, kind)`` for a document given as a VARIANT."""
    clean = _clean_shape(schema, False)
    if clean is None:
        return _let(document, lambda parsed: _violations(parsed, schema))

    def told(parsed: Column) -> Column:
        settled = F.schema_of_variant(parsed).rlike(rf"^{clean}\z")
        return F.when(settled, _none()).otherwise(_violations(parsed, schema))

    return _let(document, told)


def _violations(document: Column, schema: T.StructType) -> Column:
    here = F.lit("")

    def inside(entries: Column) -> Column:
        wrong = _one(here, "wrong_type")
        return F.when(entries.isNull(), wrong).otherwise(_check_entries(entries, schema, here))

    def whole(parsed: Column) -> Column:
        entries = F.try_variant_get(parsed, "$", "map<string,variant>")
        return F.when(parsed.isNull(), _one(here, "corrupt")).otherwise(_let(entries, inside))

    return whole(document)


def with_violations(
    df: DataFrame, text: str, schema: T.StructType, out: str = "violations"
) -> DataFrame:
    return df.withColumn(out, violations(F.try_parse_json(F.col(text)), schema))


def contract_violations(df: DataFrame, text: str, schema: T.StructType, keep=()) -> DataFrame:
    """One row per violation: the ``keep`` columns, ``path``, ``kind``."""
    # Not from a column: the optimizer would filter by its size and compute it a second time.
    return df.select(*keep, F.inline(violations(F.try_parse_json(F.col(text)), schema)))


def _aside(found: str, closed: bool) -> Column:
    """Whether what was found sets a payload aside."""
    return F.size(found) > 0 if closed else F.exists(found, lambda v: v["kind"] != "unknown_key")


def conforming(df: DataFrame, text: str, schema: T.StructType, *, closed: bool = False) -> DataFrame:
    """Payloads that nothing sets aside (the strict mode)."""
    return with_violations(df, text, schema, "_found").where(~_aside("_found", closed)).drop("_found")


def violating(df: DataFrame, text: str, schema: T.StructType, *, closed: bool = False) -> DataFrame:
    """The payloads strict mode sets aside, with what is wrong with them."""
    return with_violations(df, text, schema).where(_aside("violations", closed))
