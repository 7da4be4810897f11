"""A version's README, from its document."""

from __future__ import annotations


def grouped(n: int | None) -> str:
    return "-" if n is None else f"{n:,}"


def sized(n: int) -> str:
    """Bytes in the largest unit that leaves at least one."""
    value, unit = float(n), "B"
    for unit in ("B", "KiB", "MiB", "GiB", "TiB"):
        if value < 1024 or unit == "TiB":
            break
        value /= 1024
    return f"{n} B" if unit == "B" else f"{value:.1f} {unit}"


def cell(value) -> str:
    return str("" if value is None else value).replace("|", "\\|").replace("\n", " ")


def table(rows: list[dict], columns: list[str]) -> list[str]:
    """Only columns that have a value in some row."""
    own = [c for c in columns if any(r.get(c) not in (None, "") for r in rows)]
    if not own:
        return []
    line = lambda values: "| " + " | ".join(values) + " |"
    return [line(own), line(["-"] * len(own)), *(line([cell(r.get(c)) for c in own]) for r in rows), ""]


def render(document: dict) -> str:
    version = (document.get("version") or {}).get("id", "")
    out = [f"# {document['dataset_id']} {version}", "", document.get("purpose", ""), ""]
    for key, title in (("about", "About"), ("notes", "Notes")):
        if document.get(key):
            out += [f"## {title}", "", str(document[key]), ""]
    if document.get("sources"):
        out += ["## Sources", "", *table(document["sources"], ["name", "url", "license", "retrieved", "note"]), "Terms are those of the sources as stated above; they were not checked.", ""]
    inventory = document.get("inventory") or {}
    out += ["## Contents", "", f"{grouped(inventory.get('objects'))} files, {sized(inventory.get('bytes') or 0)}", ""]
    parts = [{"group": g["name"], "profile": g.get("profile"), "split": p.get("name"), "rows": grouped(p.get("rows"))} for g in document.get("groups", []) for p in g.get("partitions") or [{}]]
    out += table(parts, ["group", "profile", "split", "rows"])
    tokenizers = [d for g in document.get("groups", []) for d in g.get("depends_on") or [] if d.get("role") == "tokenizer"]
    if tokenizers:
        out += ["## Tokenizer", "", *[f"{d.get('dataset_id')} {d.get('version')}" for d in tokenizers], ""]
    if document.get("license"):
        out += ["## License", "", cell(document["license"].get("id") or "unknown") + f" ({cell(document['license'].get('basis') or 'unknown')})", ""]
    if document.get("limitations"):
        out += ["## Limitations", "", *[f"- {cell(x)}" for x in document["limitations"]], ""]
    if document.get("build"):
        out += ["## Provenance", "", *[f"- {k}: {cell(v)}" for k, v in sorted(document["build"].items()) if v], ""]
    out += ["## Reading", "", "```python", "from shardwright.plans.read import resolve", f'resolve(store, "{document["dataset_id"]}", "{version}")', "```", ""]
    return "\n".join(out)
