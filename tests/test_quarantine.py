"""Damaged entries cost themselves, not their table, and are kept with file and position."""

from __future__ import annotations

import json

from railloom.plans import ingest
from tests.conftest import rows, values
from tests.landing import write_landing


def test_a_file_that_breaks_off_is_loaded_and_its_end_is_kept(spark, tmp_path, zone):
    root = write_landing(tmp_path / "broken")
    file = tmp_path / "broken" / "stops.json"
    text = json.dumps({str(i): {"stop_name": f"S{i}}}", "stop_lat": "1", "stop_lon": "2"} for i in range(50)})
    file.write_text(text[:-30])
    too_bad = tmp_path / "broken" / "classes.json"
    too_bad.write_text('{"1": {"class": "a"}, "2": 3, "4": {"class": "b"}, "5": [], "6": {"class": "c"}}')
    outcome = ingest.ingest(spark, ingest.Landing(root), zone)
    assert outcome["stops"] == "loaded" and outcome["classes"] == "skipped" and not zone.exists("classes")
    assert sorted(values(zone.read("stops"), "stop_name")) == sorted(f"S{i}}}" for i in range(49))
    kept = zone.read(ingest.QUARANTINE)
    assert sorted(values(kept, "source")) == ["classes", "classes", "stops"]
    (end,) = kept.where("source = 'stops'").collect()
    assert end["file"].endswith("stops.json") and "S49" in end["text"]
    first = rows(kept)
    number = zone.release().manifest.number
    again = ingest.ingest(spark, ingest.Landing(root), zone)
    assert again["stops"] == "loaded" and rows(zone.read(ingest.QUARANTINE)) == first
    assert zone.release().entry("stops") == zone.release(number).entry("stops")  # nothing new, nothing written


def test_json_lines_with_a_bad_line(spark, tmp_path, zone):
    root = write_landing(tmp_path / "lines")
    for path in (tmp_path / "lines").glob("*.json"):
        found = json.loads(path.read_text(encoding="utf-8"))
        path.write_text("\n".join(json.dumps(v) for v in found.values()) + ('\n{"oops' if path.name == "agencies.json" else ""), encoding="utf-8")
    outcome = ingest.ingest(spark, ingest.Landing(root, night_lines=True, most_bad=0.5), zone)
    assert outcome["agencies"] == "loaded" and zone.read("agencies").count() == 3
    assert values(zone.read(ingest.QUARANTINE), "text") == ['{"oops']
