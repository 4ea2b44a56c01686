"""The SURVEY inventory map: every function exists and every listed query is registered."""

import contextlib
import io

import coverage_map


def test_inventory_map_is_complete():
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        coverage_map.main()
    rows = [line for line in buf.getvalue().splitlines() if line.startswith("| ") and line[2].isalpha()
            and line[3].isdigit()]
    assert len(rows) == len(coverage_map.MAP) >= 160
    assert "Other registered queries" not in buf.getvalue()
