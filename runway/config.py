"""Job configuration: the reference's YAML layout mapped onto ``extract_sources`` settings."""

from __future__ import annotations

# Reference section name -> (our source name, format).
SECTIONS = {
    "postgres": ("bookings", "jdbc"),
    "csv_flights": ("flights", "csv"),
    "csv_maintenance": ("maintenance", "csv"),
    "json_logs": ("logs", "json"),
    "api_weather": ("weather", "json"),
}


def from_reference(conf: dict) -> dict:
    """Translate a configuration in the reference's layout.

    ``postgres`` keeps its connection keys (the JDBC reader builds the URL)
    and may add ``partition_column``/bounds for parallel reads; ``file`` or
    ``files`` become a file list; ``processing.on_validation_error`` is kept.
    """
    sources = {}
    for section, (name, fmt) in SECTIONS.items():
        src = dict(conf.get("sources", {}).get(section, {}))
        if not src:
            continue
        out = {"enabled": bool(src.pop("enabled", False)), "format": fmt}
        if fmt == "jdbc":
            out.update(src)
        else:
            files = src.pop("files", None) or ([src.pop("file")] if "file" in src else [])
            out["files"] = [str(f) for f in files]
            out.update(src)
        sources[name] = out
    return {"sources": sources,
            "processing": {"on_validation_error": conf.get("processing", {}).get("on_validation_error", "skip")}}


def load(path: str) -> dict:
    """Read a YAML or JSON configuration; the reference's layout is recognised and translated."""
    import json
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        import yaml
        conf = yaml.safe_load(text)
    except ImportError:
        conf = json.loads(text)
    if any(k in conf.get("sources", {}) for k in SECTIONS):
        return from_reference(conf)
    return conf
