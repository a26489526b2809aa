"""What each batch brought to a table or a published folder, as small JSON files beside the data.

* Columns: a batch may have columns its contract does not list. The manifest of a table has a line
  for each of them, batch by batch, so that readers know all columns without reading data files.
* Publications: every publication of a batch notes the folders it wrote, under its table,
  source and batch. Readers follow the latest note, and only folders of earlier notes under the same
  key are ever deleted.

A file is written under another name and renamed, so it is there as a whole or not at all.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from clearwell.contracts import Contract
from clearwell.functions.names import column
from clearwell.functions.values import DATE_PARTS
from clearwell.session import hadoop_path

TABLE_COLUMNS = "table_columns"
PUBLICATIONS = "_manifest"
# A column whose type is not the one the table has it with is stored under this name, as text.
TEXT_MARK = "_text_"
# Extra columns are stored in the widest type of their kind: a batch of small numbers sets no limit.
_WIDEST = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "float": "double"}


def write_json(spark: SparkSession, path: str, rows: Sequence[dict]) -> None:
    files, target = hadoop_path(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.draft")
    out = files.create(draft, True)
    try:
        out.write(bytearray("".join(json.dumps(row) + "\n" for row in rows), "utf-8"))
    finally:
        out.close()
    files.delete(target, False)
    if not files.rename(draft, target):
        raise OSError(f"{path} could not be written")


def read_json(spark: SparkSession, path: str) -> list[dict]:
    """The lines of the JSON files directly in a folder, by file name; none for a folder that is not there."""
    files, folder = hadoop_path(spark, path)
    if not files.exists(folder):
        return []
    found = []
    for status in sorted(files.listStatus(folder), key=lambda s: s.getPath().getName()):
        name = status.getPath().getName()
        if name.endswith(".json"):
            data = files.open(status.getPath())
            try:
                lines = bytes(data.readAllBytes()).decode("utf-8").splitlines()
            finally:
                data.close()
            found += [json.loads(line) | {"file": name} for line in lines]
    return found


# Columns.


@dataclass(frozen=True)
class Extra:
    """A column beyond the contract as readers get it: its type, and whether some batches have it as text."""

    name: str
    kind: str
    drifted: bool = False

    def value(self) -> Column:
        if not self.drifted:
            return column(self.name)
        return F.coalesce(_as_text(column(self.name), self.kind), column(TEXT_MARK + self.name)).alias(self.name)

    def sql(self) -> str:
        """``value`` for SQL text."""
        if not self.drifted:
            return f"`{self.name}`"
        nested = not isinstance(json.loads(self.kind), str)
        text = f"to_json(`{self.name}`)" if nested else f"CAST(`{self.name}` AS STRING)"
        return f"coalesce({text}, `{TEXT_MARK}{self.name}`) AS `{self.name}`"

    def stored(self) -> list[StructField]:
        field = StructField.fromJson(
            {"name": self.name, "type": json.loads(self.kind), "nullable": True, "metadata": {}}
        )
        return [field, StructField(TEXT_MARK + self.name, _TEXT)] if self.drifted else [field]


_TEXT = StringType()


def _as_text(value: Column, kind: str) -> Column:
    nested = not isinstance(json.loads(kind), str)
    return F.to_json(value) if nested else value.cast("string")


def _columns_folder(lake: str, table: str) -> str:
    return f"{lake.rstrip('/')}/{TABLE_COLUMNS}/{quote(table, safe='')}"


def noted_columns(spark: SparkSession, lake: str, table: str) -> list[dict]:
    return read_json(spark, _columns_folder(lake, table))


def extras_of(spark: SparkSession, lake: str, table: str) -> list[Extra]:
    """All columns that batches of a table have beyond its contract, in the order in which batches brought them."""
    kinds: dict[str, str] = {}
    drifted = set()
    for row in sorted(noted_columns(spark, lake, table), key=lambda row: (row["position"], row["name"])):
        if row["text"]:
            drifted.add(row["name"])
            kinds.setdefault(row["name"], '"string"')
        else:
            kinds[row["name"]] = row["kind"]
    return [Extra(name, kind, name in drifted) for name, kind in kinds.items()]


def note_extras(spark: SparkSession, lake: str, contract: Contract, extras: Sequence[Extra]) -> None:
    """Note columns for the table as a whole; unlike the notes of a batch, these are never taken back."""
    notes = []
    for position, extra in enumerate(extras):
        common = {"name": extra.name, "position": position}
        notes.append(common | {"kind": extra.kind, "text": False})
        if extra.drifted:
            notes.append(common | {"kind": extra.kind, "text": True})
    # No batch id has such a name.
    write_json(spark, f"{_columns_folder(lake, contract.name)}/%40table.json", notes)


def settle_columns(
    spark: SparkSession, lake: str, contract: Contract, batch_id: str, marked: DataFrame, marks: Sequence[str]
) -> DataFrame:
    """The rows of a batch with columns that fit what the table has, after a note of those beyond the contract.

    A column that earlier batches have in another type goes into a text column beside it: data
    files of one name never differ in type. The note comes first, so no column is stored unknown.
    """
    others = [row for row in noted_columns(spark, lake, contract.name) if row["file"] != f"{quote(batch_id, safe='')}.json"]
    known = {row["name"]: row["kind"] for row in others if not row["text"]}
    kept, notes = [], []
    for position, field in enumerate(marked.schema.fields):
        value = column(field.name)
        if field.name in contract.columns or field.name in marks:
            kept.append(value)
            continue
        wide = _WIDEST.get(field.dataType.simpleString())
        if wide:
            value = value.cast(wide).alias(field.name)
        kind = marked.select(value).schema[0].dataType
        if kind.simpleString() == "void":
            value, kind = value.cast("string").alias(field.name), _TEXT
        text = known.get(field.name, kind.json()) != kind.json()
        notes.append({"name": field.name, "kind": kind.json(), "position": position, "text": text})
        kept.append(_as_text(value, kind.json()).alias(TEXT_MARK + field.name) if text else value)
    write_json(spark, f"{_columns_folder(lake, contract.name)}/{quote(batch_id, safe='')}.json", notes)
    return marked.select(*kept)


# Publications.


@dataclass(frozen=True)
class Publication:
    """One place in a published folder that a table, source and batch have for themselves."""

    root: str
    table: str
    source: str
    batch: str

    @property
    def folder(self) -> str:
        parts = (quote(part, safe="") or "%" for part in (self.source, self.batch, self.table))
        return "/".join([self.root.rstrip("/"), PUBLICATIONS, *parts])

    def notes(self, spark: SparkSession) -> list[dict]:
        return read_json(spark, self.folder)

    def note(self, spark: SparkSession, version: int, label: str, days: Sequence[Sequence[str | None]]) -> None:
        common = {"table": self.table, "source": self.source, "batch": self.batch, "version": version, "label": label}
        rows = [common | dict(zip(DATE_PARTS, day, strict=True)) | {"empty": False} for day in days]
        # A publication without rows is noted too.
        write_json(spark, f"{self.folder}/{version:08d}.json", rows or [common | {"empty": True}])


def label_of(spark: SparkSession, place: Publication) -> str:
    """The name of a publication's folders: the batch id, with the table where another table has that already."""
    own = place.notes(spark)
    if own:
        return own[-1]["label"]
    files, above = hadoop_path(spark, place.folder.rsplit("/", 1)[0])
    taken = files.exists(above) and len(files.listStatus(above)) > 0
    return f"{place.batch.replace('@', '.')}@{place.table}" if taken else place.batch


def published_rows(
    spark: SparkSession, root: str, schema: str, folders: Sequence[str], table: str | None = None
) -> DataFrame:
    """The rows of the latest publication of each table, source and batch, and of no other folder.

    ``folders`` are the partition columns of the published folder, the batch last; ``schema`` lists the data columns.
    """
    ddl = ", ".join(f"`{name}` string" for name in ("table", "source", "batch", "label", *DATE_PARTS))
    notes = spark.read.schema(f"{ddl}, version bigint, empty boolean").option("recursiveFileLookup", True)
    notes = notes.json(f"{root.rstrip('/')}/{PUBLICATIONS}")
    if table is not None:
        notes = notes.where(F.col("table") == table)
    key = ["table", "source", "batch"]
    latest = notes.groupBy(*key).agg(F.max("version").alias("version"))
    current = notes.join(latest, [*key, "version"], "left_semi").where("NOT empty")
    values = {"source": "source", folders[-1]: "label"} | {name: name for name in DATE_PARTS}
    places = current.select(*[F.col(values[name]).alias(f"_at_{name}") for name in folders]).distinct()
    all_folders = ", ".join(f"`{name}` string" for name in folders)
    rows = spark.read.schema(f"{schema}, {all_folders}").parquet(root)
    same = reduce(and_, [rows[name].eqNullSafe(places[f"_at_{name}"]) for name in folders])
    return rows.join(places, same, "left_semi")
