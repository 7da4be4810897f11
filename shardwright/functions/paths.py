"""Column expressions over object paths: names, splits, labels, globs and what extensions claim."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The split vocabulary and the names of path labels, outermost first.
SPLITS = ("train", "val", "test")
TRAINABLE = ("train",)
LABEL_KEYS = ("source", "domain")

# A shard is <split words>-<five digits>.<ext>; each word has a letter.
_WORD = "[a-z0-9]*[a-z][a-z0-9]*"
SHARD = rf"^({_WORD}(?:-{_WORD})*)-(\d{{5}})\.([A-Za-z0-9.]+)\z"
CAS = r"^[0-9a-f]{64}\.[A-Za-z0-9.]+\z"

# Bytes of an element.
WIDTHS = {"uint8": 1, "uint16": 2, "uint32": 4, "int32": 4, "float32": 4, "float16": 2, "int64": 8, "float64": 8}
_CODES = {"uint16": "u16", "uint32": "u32", "int32": "i32", "int64": "i64", "float16": "f16", "float32": "f32", "float64": "f64"}


def _claims() -> dict[str, dict]:
    """What each extension says of its file's format."""
    raw = {"container": "raw", "codec": "none", "header_bytes": 0}
    out = {".u8.bin": raw | {"dtype": "uint8"}}
    for dtype, code in _CODES.items():
        for end, order in (("le", "little"), ("be", "big")):
            out[f".{code}{end}.bin"] = raw | {"dtype": dtype, "byte_order": order}
    for kind in ("jsonl", "csv"):
        out |= {f".{kind}": {"container": kind, "codec": "none"}, f".{kind}.gz": {"container": kind, "codec": "gzip"}}
    return out | {".parquet": {"container": "parquet"}, ".json": {"container": "json", "codec": "none"}, ".txt": {"container": "text", "codec": "none"}, ".npy": {"container": "npy", "codec": "none", "min_header_bytes": 1}}


CLAIMS = _claims()


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def group_of(path: Column) -> Column:
    """The first segment; empty where there is only one."""
    return F.when(F.instr(path, "/") > 0, F.split(path, "/")[0]).otherwise("")


def _or_null(text: Column) -> Column:
    return F.when(text != "", text)


def shard_split(path: Column) -> Column:
    return _or_null(F.regexp_extract(base_name(path), SHARD, 1))


def shard_ordinal(path: Column) -> Column:
    return _or_null(F.regexp_extract(base_name(path), SHARD, 2)).cast("int")


def is_cas(path: Column) -> Column:
    return base_name(path).rlike(CAS)


def label_segments(path: Column) -> Column:
    """Segments between the group and the file."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 2, F.slice(parts, F.lit(2), F.size(parts) - 2)).otherwise(F.array().cast("array<string>"))


def labels(path: Column, keys=LABEL_KEYS) -> Column:
    """Map of labels; null where the path is nested deeper than there are keys."""
    found = label_segments(path)
    names = F.slice(F.array(*[F.lit(k) for k in keys]), F.lit(1), F.size(found))
    return F.when(F.size(found) <= len(keys), F.map_from_arrays(names, found))


def is_trainable(split: Column) -> Column:
    return F.coalesce(split.isin(*TRAINABLE), F.lit(False))


def glob_pattern(glob: str) -> str:
    """A shell glob as an anchored regular expression; * and ? match any character, / too."""
    out, i = "", 0
    while i < len(glob):
        c = glob[i]
        close = glob.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif close > 0:
            inside = glob[i + 1 : close].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&")
            out += f"[{'^' + inside[1:] if inside[0] == '!' else inside}]"
            i = close
        else:
            out += re.escape(c)
        i += 1
    return rf"(?s)\A{out}\z"


def matches_glob(path: Column, glob: str) -> Column:
    """On the file name or the whole path."""
    pattern = glob_pattern(glob)
    return base_name(path).rlike(pattern) | path.rlike(pattern)


def extension(path: Column) -> Column:
    """The longest known extension, whatever its case; null if there is none."""
    known = "|".join(map(re.escape, sorted(CLAIMS, key=len, reverse=True)))
    return F.nullif(F.regexp_extract(F.lower(path), f"(?:{known})$", 0), F.lit(""))  # leftmost, so longest


def claimed(path: Column, field: str) -> Column:
    """The value of a field that the extension claims; null where it claims none."""
    own = [F.lit(x) for e, c in CLAIMS.items() if field in c for x in (e, c[field])]
    return F.element_at(F.create_map(*own), extension(path))


def width(dtype: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in WIDTHS.items() for x in kv]), dtype)


def least_width(vocab: Column) -> Column:
    """Bytes of the narrowest unsigned type for ids below vocab."""
    return F.when(vocab - 1 <= 0xFF, 1).when(vocab - 1 <= 0xFFFF, 2).when(vocab - 1 <= 0xFFFFFFFF, 4).otherwise(8)


def depth(path: Column) -> Column:
    return F.size(F.split(path, "/")) - 1


# Control documents.
ROOT_CONTROLS = ("dataset.json", "_SUCCESS", "_VALIDATED.json", "_REJECTED.json", "README.md", "manifest.json")


def is_control(path: Column) -> Column:
    """Control documents at the root, a group's manifest one level down, and the catalog's and dependents' folders."""
    name = base_name(path)
    return (
        ((depth(path) == 0) & name.isin(*ROOT_CONTROLS))
        | ((depth(path) == 1) & (name == "manifest.json"))
        | path.startswith("_catalog/")
        | path.startswith("dependents/")
    )
