"""Schemas that drift between files: one typed table, a rescue column, and a report of each change.

Ingestion enforces a target schema. Fields it does not know, and values that do
not fit its types, are kept as JSON in ``_rescued``; ``_fields`` records which
fields a line had and of what type, typed and rescued ones alike, null ones too.
The report compares the fields of each file with the file before it in its feed;
``promotions`` proposes from it where renamed, added and retyped fields belong;
once approved, ``replay`` moves their rescued values into typed columns.

Parsing JSON of any shape is the one thing done in Python here (Arrow batches,
the C parser), because built-in parsing wants the schema first. A line's fields
are summed up by file in the task, so the exchange carries one row per file,
field and task at most.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordia.runtime import cut

RESCUED, FIELDS = "_rescued", "_fields"

#: What a value must be to fit a column of the target schema without loss.
_FITS = {
    "string": lambda v: isinstance(v, str),
    "bigint": lambda v: isinstance(v, int) and not isinstance(v, bool) and -(1 << 63) <= v < 1 << 63,
    "double": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "array<string>": lambda v: isinstance(v, list) and all(x is None or isinstance(x, str) for x in v),
}
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}


def _reject(word: str):
    raise ValueError(word)


def parse_object(payload: str | None) -> dict | None:
    """The JSON object of a line, None where the line is malformed, empty or no object. Of a repeated key the last value counts."""
    if not payload:
        return None
    try:
        value = json.loads(payload, parse_constant=_reject)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def leaves(value: dict, prefix: str = "") -> Iterator[tuple[str, object]]:
    """Dotted paths and their values: through objects, not into lists; an empty object has none."""
    stack = [(prefix, value)]
    while stack:
        at, node = stack.pop()
        for k, v in node.items():
            if isinstance(v, dict):
                stack.append((f"{at}{k}.", v))
            else:
                yield at + k, v


def type_of(value: object) -> str | None:
    """string, number, boolean, ``list of ...``; None where the value tells no type (null, empty list, list of nulls)."""
    if isinstance(value, list):
        inner = next((x for x in value if x is not None), None)
        if isinstance(inner, dict):
            return "list of objects"
        return None if inner is None else "list of lists" if isinstance(inner, list) else f"list of {type_of(inner)}s"
    if isinstance(value, bool):
        return "boolean"
    return "string" if isinstance(value, str) else "number" if isinstance(value, (int, float)) else None


#: Types a field can have, in the order of their codes from 1.
TYPES = ["string", "number", "boolean", "list of strings", "list of objects", "list of numbers", "list of booleans", "list of lists"]


def file_fields(ingested: DataFrame, file_keys: list[str], line_no: str) -> DataFrame:
    """``file_keys``, ``field_path``, ``field_type`` (null where no line tells it): the fields of each file.

    ``ingested``: as of :func:`ingest`. A path is in a file if any well-formed line has it, even as null. If lines of a file disagree on a type, the last line counts.
    """
    each = ingested.select(*file_keys, F.coalesce(F.col(line_no).cast("long"), F.lit(-1)).alias("_at"), F.explode(FIELDS).alias("field_path", "_type"))
    # line number and type in one number, so that the maximum combines in the hash aggregate
    code = F.nullif(F.array_position(F.array(*map(F.lit, TYPES)), F.col("_type")), F.lit(0))
    last = each.groupBy(*file_keys, "field_path").agg(F.max(F.col("_at") * 16 + code).alias("_last"))
    return last.select(*file_keys, "field_path", F.try_element_at(F.array(*map(F.lit, TYPES)), F.nullif(F.pmod("_last", F.lit(16)).cast("int"), F.lit(0))).alias("field_type"))


def field_changes(fields: DataFrame, feed: str, file_name: str, order: list[str]) -> DataFrame:
    """``feed``, ``file_name``, ``field_path``, ``change_kind``, ``old_type``, ``new_type``, ``old_path``: what changed against the file before in the feed.

    ``fields``: as of :func:`file_fields`. Files of a feed are ordered by ``order`` (then by name). Without a type in a
    file, the last one known in the feed stands. renamed: exactly one path ends and exactly one begins, of one known type;
    else added and removed. retyped: in both files, with another type. First files have no changes, nor have files without a well-formed line.

    Windows run over files and fields, never over lines. Files get their numbers first, from one row per file.
    """
    fields = cut(fields)  # three reads of it below; it is a row per file and field, the lines are many times that
    files = fields.select(feed, file_name, *order).distinct()
    numbered = files.withColumn("file_no", F.row_number().over(Window.partitionBy(feed).orderBy(*order, file_name)))
    numbered = numbered.withColumn("last_no", F.max("file_no").over(Window.partitionBy(feed)))
    at = fields.join(numbered, [feed, file_name, *order]).select(feed, "file_no", "last_no", "field_path", "field_type")

    along = Window.partitionBy(feed, "field_path").orderBy("file_no")
    known = at.withColumn("kind", F.last("field_type", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    seen = known.withColumns({"before_no": F.lag("file_no").over(along), "before_kind": F.lag("kind").over(along), "after_no": F.lead("file_no").over(along)})
    follows = F.coalesce(F.col("before_no") == F.col("file_no") - 1, F.lit(False))
    begins = F.when((F.col("file_no") > 1) & ~follows, F.struct(F.col("file_no").alias("no"), F.lit("added").alias("what"), F.lit(None).cast("string").alias("old"), F.col("kind").alias("new")))
    ends = F.when((F.col("file_no") < F.col("last_no")) & ~F.coalesce(F.col("after_no") == F.col("file_no") + 1, F.lit(False)), F.struct((F.col("file_no") + 1).alias("no"), F.lit("removed").alias("what"), F.col("kind").alias("old"), F.lit(None).cast("string").alias("new")))
    turns = F.when(follows & (F.col("kind") != F.col("before_kind")), F.struct(F.col("file_no").alias("no"), F.lit("retyped").alias("what"), F.col("before_kind").alias("old"), F.col("kind").alias("new")))
    events = seen.select(feed, "field_path", F.explode(F.array_compact(F.array(begins, ends, turns))).alias("e")).select(feed, "field_path", F.col("e.no").alias("file_no"), "e.what", "e.old", "e.new")

    here = Window.partitionBy(feed, "file_no")
    added, removed = F.col("what") == "added", F.col("what") == "removed"
    events = events.withColumns({
        "n_added": F.count_if(added).over(here), "n_removed": F.count_if(removed).over(here),
        "new_kind": F.max(F.when(added, F.col("new"))).over(here), "old_kind": F.max(F.when(removed, F.col("old"))).over(here),
        "ended": F.max(F.when(removed, F.col("field_path"))).over(here),
    })
    renamed = (F.col("n_added") == 1) & (F.col("n_removed") == 1) & F.coalesce(F.col("new_kind") == F.col("old_kind"), F.lit(False))
    kept = events.where(~(renamed & removed))
    is_new_name = renamed & added
    kept = kept.select(
        feed, "file_no", "field_path", F.when(is_new_name, "renamed").otherwise(F.col("what")).alias("change_kind"),
        F.when(is_new_name, F.col("old_kind")).otherwise(F.col("old")).alias("old_type"), F.col("new").alias("new_type"), F.when(is_new_name, F.col("ended")).alias("old_path"),
    )
    return kept.join(numbered.select(feed, file_name, "file_no"), [feed, "file_no"]).select(feed, file_name, "field_path", "change_kind", "old_type", "new_type", "old_path")


def ingest(lines: DataFrame, payload: str, target: dict[str, str]) -> DataFrame:
    """``lines`` without ``payload``, plus a column for each dotted path of ``target``, ``_rescued`` and ``_fields``.

    ``target`` maps dotted paths to string, bigint, double, boolean or array<string>; a path's column is named with ``_`` for its
    dots. ``_rescued`` is a JSON object of the paths that are unknown or whose value does not fit, null where
    there are none. ``_fields`` maps every path of the line to its type (null where the value tells none), null where the line is malformed or empty.
    Of a malformed line all target columns are null and ``_rescued`` holds {"_malformed": text}; of an empty line nothing.
    A target column that clashes with one of ``lines`` takes the place of nothing: the old one is renamed ``source_<name>``.
    """
    columns = {p: p.replace(".", "_") for p in target}
    rest = [c for c in lines.columns if c != payload]
    new_names = {c.lower() for c in [*columns.values(), RESCUED, FIELDS]}
    old_names = {c: f"source_{c}" if c.lower() in new_names else c for c in rest}
    base = lines.select(*[F.col(f"`{c}`").alias(n) for c, n in old_names.items()], F.col(f"`{payload}`").alias("_payload"))
    fields = [*[f for f in base.schema.fields if f.name != "_payload"], *[T.StructField(columns[p], T._parse_datatype_string(t)) for p, t in target.items()], T.StructField(RESCUED, T.StringType()), T.StructField(FIELDS, T.MapType(T.StringType(), T.StringType()))]

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            typed: dict[str, list] = {p: [] for p in target}
            rescued: list[str | None] = []
            paths: list[str] = []
            kinds: list[str | None] = []
            ends: list[int | None] = [0]
            for text in batch.column("_payload").to_pylist():
                value = parse_object(text)
                left: dict[str, object] = {}
                got: dict[str, object] = {}
                if value is None:
                    if text and text.strip():
                        left["_malformed"] = text
                else:
                    for path, v in leaves(value):
                        paths.append(path)
                        kinds.append(type_of(v))
                        kind = target.get(path)
                        if kind is not None and (v is None or _FITS[kind](v)):
                            got[path] = v
                        elif v is not None or kind is None:
                            left[path] = v
                for p, out in typed.items():
                    out.append(got.get(p))
                rescued.append(json.dumps(left, ensure_ascii=False, sort_keys=True) if left else None)
                ends.append(len(paths))
                if value is None:  # an offset that is null makes the map that begins there null
                    ends[-2] = None
            keep = [i for i, n in enumerate(batch.schema.names) if n != "_payload"]
            arrays = [batch.column(i) for i in keep] + [pa.array(typed[p], _ARROW[t]) for p, t in target.items()] + [pa.array(rescued, pa.string())]
            arrays.append(pa.MapArray.from_arrays(pa.array(ends, pa.int32()), pa.array(paths, pa.string()), pa.array(kinds, pa.string())))
            yield pa.RecordBatch.from_arrays(arrays, names=[batch.schema.names[i] for i in keep] + list(columns.values()) + [RESCUED, FIELDS])

    return base.mapInArrow(convert, T.StructType(fields))


def _rescued_as(variant: Column, path: str, kind: str) -> Column:
    """A rescued value as ``kind``, null where it is absent or cannot be written in that type without loss; JVM-side."""
    at = "$['" + path.replace("'", "\\'") + "']"
    get = lambda t: F.try_variant_get(variant, at, t)
    shape = F.schema_of_variant(get("variant"))
    number, text = shape.rlike("^(BIGINT|DOUBLE|DECIMAL)"), shape == "STRING"
    if kind == "boolean":
        word = F.lower(F.trim(get("string")))
        return F.when(shape == "BOOLEAN", get("boolean")).when(text & word.isin("true", "yes"), True).when(text & word.isin("false", "no"), False)
    if kind == "bigint":
        return F.when((shape == "BIGINT") | text & get("string").rlike(r"^\s*[+-]?\d{1,18}\s*$"), get("string").try_cast("bigint"))
    if kind == "double":
        return F.when(number | text & get("string").rlike(r"^\s*[+-]?\d+(\.\d+)?([eE][+-]?\d{1,3})?\s*$"), get("string").try_cast("double"))
    if kind == "string":
        return F.when(text | number | (shape == "BOOLEAN"), get("string")).when(shape.rlike("^(ARRAY|OBJECT)"), F.to_json(get("variant")))
    words = F.filter(F.transform(F.split(get("string"), "[,;]"), lambda x: F.trim(x)), lambda x: x != "")
    listed = F.when(shape.rlike("^ARRAY<(STRING|VOID)>$"), get("array<string>")).when(text, words)
    return listed.when(shape.startswith("ARRAY<OBJECT"), F.transform(get("array<variant>"), lambda x: F.to_json(x)))


def promotions(report: DataFrame, target: dict[str, str]) -> dict[str, tuple[str, str]]:
    """path -> (column, type): where the fields of a report (as of :func:`field_changes`) belong, as proposals for :func:`replay`.

    A field of the target stays in its own column (so that retyped values are written in its type). A renamed one goes to the column of the name it had
    first (of several the most frequent, then the first by name); any other new field gets its own column, of the type it began with most often.
    What is collected is a row per field name and change, however many lines and files there are.
    """
    names = report.groupBy("field_path", "old_path", "change_kind", "new_type").agg(F.count(F.lit(1)).alias("n")).collect()
    before: dict[str, dict[str, int]] = {}
    kinds: dict[str, dict[str, int]] = {}
    for r in names:
        if r["change_kind"] == "renamed":
            votes = before.setdefault(r["field_path"], {})
            votes[r["old_path"]] = votes.get(r["old_path"], 0) + r["n"]
        if r["change_kind"] in ("added", "renamed"):
            seen_as = kinds.setdefault(r["field_path"], {})
            seen_as[r["new_type"] or "string"] = seen_as.get(r["new_type"] or "string", 0) + r["n"]
    of_type = {"boolean": "boolean", "number": "double"}
    column = {p.lower(): p.replace(".", "_") for p in target}
    out = {p: (p.replace(".", "_"), t) for p, t in target.items()}
    for path in sorted(kinds):
        if path in target:
            continue
        root, seen = path, {path}
        while root not in target and root in before:
            step = min(before[root].items(), key=lambda kv: (kv[0] not in target, -kv[1], kv[0]))[0]
            if step in seen:
                break
            seen.add(step)
            root = step
        known = next((p for p in target if p.lower() == root.lower()), None)
        if known:
            out[path] = (column[known.lower()], target[known])
            continue
        kind = min(kinds.get(root, kinds[path]).items(), key=lambda kv: (-kv[1], kv[0]))[0]
        name = column.setdefault(root.lower(), root.replace(".", "_"))
        out[path] = (name, of_type.get(kind, "array<string>" if kind.startswith("list") else "string"))
    return out


def replay(table: DataFrame, approved: dict[str, tuple[str, str]]) -> DataFrame:
    """Rescued values of approved paths moved into typed columns.

    ``approved`` maps a path to (column, type). A column that exists is filled where it is null (so a renamed field lands in its old column), of several
    paths of a column by the first that has a value; another is created. A number given as text goes into a number column, a lone text or one with
    separators into a list, a number into a text column, objects as their JSON; what cannot be written in the type without loss stays in
    ``_rescued``, and what was moved, or is null, leaves it. The rescued JSON is parsed once.
    """
    if not approved:
        return table
    names = {c.lower(): c for c in table.columns}
    columns: dict[str, tuple[str, str, list[str]]] = {}
    for path, (column, kind) in approved.items():
        columns.setdefault(column.lower(), (names.get(column.lower(), column), kind, []))[2].append(path)
    parsed = table.withColumn("_variant", F.when(~F.startswith(RESCUED, F.lit('{"_malformed"')), F.try_parse_json(F.col(RESCUED))))
    found = parsed.withColumns({f"_found{i}": F.array_compact(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(p).alias("path"), v.alias("value"))) for p in paths for v in [_rescued_as(F.col("_variant"), p, kind)]])) for i, (_, kind, paths) in enumerate(columns.values())})
    moved, filled = [], {}
    for i, (key, (column, kind, _)) in enumerate(columns.items()):
        first = F.try_element_at(f"_found{i}", F.lit(1))
        free = F.col(f"`{column}`").isNull() if key in names else F.lit(True)
        moved.append(F.when(free, first["path"]))
        filled[column] = F.coalesce(F.col(f"`{column}`"), first["value"]) if key in names else first["value"]
    out = found.withColumn("_gone", F.array_compact(F.array(*moved))).withColumns(filled)
    settled = lambda k, v: F.array_contains(F.col("_gone"), k) | k.isin(list(approved)) & F.is_variant_null(v)
    left = F.map_filter(F.from_json(RESCUED, "map<string,variant>"), lambda k, v: ~settled(k, v))
    rest = F.when(F.col("_variant").isNull(), F.col(RESCUED)).when(F.size(F.map_keys(left)) > 0, F.to_json(left))
    return out.withColumn(RESCUED, rest).drop("_variant", "_gone", *[f"_found{i}" for i in range(len(columns))])
