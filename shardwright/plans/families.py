"""What each family of datasets takes for granted; a dataset's own fields come first."""

from __future__ import annotations

import json
import os
from pathlib import Path

_RAW = {"container": "raw", "dtype": "uint32", "byte_order": "little", "header_bytes": 0, "codec": "none"}
_LINES = {"container": "jsonl", "codec": "gzip"}

# Profiles, formats and bounds.
FAMILIES: dict[str, dict] = {
    "pretrain": _RAW | {"profile": "pretrain-tokens/v1", "coverage": "partition", "distinct_ids_min": 256, "eos_fraction_max": 0.05, "zero_run_max": 256, "window_bytes": 65_536, "validation_required": True},
    "curriculum": _RAW | {"profile": "token-order/v1", "coverage": "overlapping", "raw_unit": "indices", "max_order_bytes": 512 << 20, "validation_required": True},
    "sft": _LINES | {"profile": "sft-conversations/v1", "coverage": "partition", "validation_required": True},
    "eval": {"profile": "eval-results/v1", "validation_required": False},
    "probe": _LINES | {"coverage": "partition", "validation_required": False},
    "tokenizer": {"profile": "tokenizer/v1", "validation_required": False},
    "vendor": {"validation_required": False},
}


#: A folder whose <family>.json files say what their families take for granted, in place of the above.
FOLDER = "SHARDWRIGHT_FAMILIES"


def families() -> dict[str, dict]:
    folder = os.environ.get(FOLDER)
    own = {p.stem: json.loads(p.read_text("utf-8")) for p in sorted(Path(folder).glob("*.json"))} if folder else {}
    return FAMILIES | own


def defaults(dataset_id: str) -> dict:
    return families().get(dataset_id.split("/")[0], {})
