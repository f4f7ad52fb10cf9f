"""64-bit Rabin fingerprint used to identify a record schema by its canonical text."""

from __future__ import annotations

import json

# Fixed value: the fingerprint of the empty string in the Avro specification.
EMPTY_FINGERPRINT = 0xC15D213AA4D7A795


def _table() -> list[int]:
    table = []
    for i in range(256):
        fp = i
        for _ in range(8):
            fp = (fp >> 1) ^ (EMPTY_FINGERPRINT if fp & 1 else 0)
        table.append(fp)
    return table


def crc64(data: bytes) -> int:
    table = _table()
    fp = EMPTY_FINGERPRINT
    for byte in data:
        fp = (fp >> 8) ^ table[(fp ^ byte) & 0xFF]
    return fp


def canonical(schema) -> str:
    """Parsing canonical form: full names, known attributes only, fixed order."""
    return _canon(json.loads(schema) if isinstance(schema, str) else schema, "")


def _canon(s, space: str) -> str:
    if isinstance(s, str):
        return json.dumps(s)
    if isinstance(s, list):
        return "[" + ",".join(_canon(x, space) for x in s) + "]"
    kind = s["type"]
    if not isinstance(kind, str) or kind not in ("record", "error", "enum", "fixed", "array", "map"):
        return _canon(kind, space)
    parts = []
    if "name" in s:
        name = s["name"]
        space = name.rpartition(".")[0] if "." in name else s.get("namespace", space)
        full = name if "." in name or not space else f"{space}.{name}"
        parts.append('"name":' + json.dumps(full))
    parts.append('"type":' + json.dumps(kind))
    if kind in ("record", "error"):
        fields = ",".join(
            '{"name":' + json.dumps(f["name"]) + ',"type":' + _canon(f["type"], space) + "}"
            for f in s["fields"]
        )
        parts.append('"fields":[' + fields + "]")
    if kind == "enum":
        parts.append('"symbols":' + json.dumps(s["symbols"], separators=(",", ":")))
    if kind == "array":
        parts.append('"items":' + _canon(s["items"], space))
    if kind == "map":
        parts.append('"values":' + _canon(s["values"], space))
    if kind == "fixed":
        parts.append('"size":' + str(int(s["size"])))
    return "{" + ",".join(parts) + "}"


def schema_hash(schema) -> str:
    """Hex of the fingerprint, least significant byte first."""
    return crc64(canonical(schema).encode()).to_bytes(8, "little").hex()
