"""Record shapes, and the bridge between Avro schema text and ``StructType``."""

from __future__ import annotations

import json

from pyspark.sql import types as T


def _record(*fields: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType(
        [T.StructField(f[0], f[1], f[2] if len(f) == 3 else False) for f in fields]
    )


STRING, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
DOUBLE, BOOLEAN = T.DoubleType(), T.BooleanType()

# Field names and types of the records users exchange.
PAGE_VIEW = _record(
    ("user", STRING), ("page", STRING), ("industry", STRING), ("flags", STRING, True)
)
PAGE_VIEW_STATS = _record(
    ("user", STRING), ("page", STRING), ("industry", STRING), ("count", LONG)
)
PLAY_EVENT = _record(("song_id", LONG), ("duration", LONG))

# The accumulated rank table; the first four columns are its key.
COMMON_RANK_KEYS = ("user_project", "rank_type", "rank_id", "rank_channel")
COMMON_RANK = _record(
    ("user_project", STRING), ("rank_type", STRING), ("rank_id", STRING),
    ("rank_channel", STRING), ("rank_name", STRING, True), ("rank_value", LONG, True),
    ("update_date", LONG, True),
)

# The fields of a behaviour event that some job reads; the JSON parser skips the rest.
BEHAVIOUR_EVENT = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("event", STRING),
        T.StructField("project", STRING),
        T.StructField("properties", T.StructType([
            T.StructField("search_word", STRING),
            T.StructField("product_id", STRING),
            T.StructField("channel", STRING),
        ])),
    ])),
])

_AVRO_TO_SPARK = {
    "string": STRING, "long": LONG, "int": INT, "double": DOUBLE,
    "float": T.FloatType(), "boolean": BOOLEAN, "bytes": T.BinaryType(),
}
_SPARK_TO_AVRO = {v.typeName(): k for k, v in _AVRO_TO_SPARK.items()} | {"integer": "int"}


def read_avsc(text: str) -> dict[str, T.StructType]:
    """Record name -> ``StructType`` for Avro schema text (one schema or a list).

    Enums become strings; ``null`` unions become nullable fields; a type may
    name a record or enum declared earlier in the same text.
    """
    known: dict[str, T.DataType] = {}

    def resolve(node) -> tuple[T.DataType, bool]:
        if isinstance(node, list):
            rest = [n for n in node if n != "null"]
            if len(rest) != 1:
                raise ValueError(f"only unions with null are supported: {node}")
            return resolve(rest[0])[0], "null" in node
        if isinstance(node, str):
            found = _AVRO_TO_SPARK.get(node) or known.get(node.rsplit(".", 1)[-1])
            if found is None:
                raise ValueError(f"unknown type {node!r}")
            return found, False
        if node["type"] == "enum":
            known[node["name"]] = STRING
            return STRING, False
        if node["type"] == "record":
            known[node["name"]] = T.StructType(
                [T.StructField(f["name"], *resolve(f["type"])) for f in node["fields"]]
            )
            return known[node["name"]], False
        return resolve(node["type"])

    parsed = json.loads(text)
    for declared in parsed if isinstance(parsed, list) else [parsed]:
        resolve(declared)
    return {name: t for name, t in known.items() if isinstance(t, T.StructType)}


def to_avsc(name: str, record: T.StructType) -> str:
    """Avro schema text for a flat or nested record, as ``from_avro`` expects."""

    def node(path: str, data_type: T.DataType):
        if not isinstance(data_type, T.StructType):
            return _SPARK_TO_AVRO[data_type.typeName()]
        return {"type": "record", "name": path, "fields": [field(path, f) for f in data_type]}

    def field(path: str, f: T.StructField) -> dict:
        avro = node(f"{path}_{f.name}", f.dataType)
        if not f.nullable:
            return {"name": f.name, "type": avro}
        return {"name": f.name, "type": ["null", avro], "default": None}

    return json.dumps(node(name, record))
