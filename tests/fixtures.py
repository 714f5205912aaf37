"""Submission files for tests: a clean return from the contract, changed cell by cell.

A fault is a list of edits of the clean rows.  An edit is (row, column, value)
for a cell, ("drop", row), ("repeat", row) or ("manifest", field, change).
"""
from __future__ import annotations

import hashlib
import json
from pathlib import Path

from lakepipe.contracts import load_contract
from lakepipe.sources.reference import codes

CODES = codes("lcr_line_codes")
COLUMNS = load_contract().column_names
HEADER = ",".join(COLUMNS)
HQLA, LAST = 0, len(CODES) - 1

FAULTS: dict[str, list[tuple]] = {
    "negative_amount": [(HQLA, "amount", "-12.25")],
    "missing_line": [("drop", LAST)],
    "bad_currency": [(2, "currency", "XXX")],
    "duplicate_row": [("repeat", 4)],
    "manifest_mismatch": [("manifest", "record_count", lambda n: n + 1)],
    "zero_amounts": [(i, "amount", "0.00") for i in range(len(CODES))],
    "unknown_code": [(3, "line_code", "OUT_UNKNOWN")],
    "wrong_total": [("manifest", "control_total", lambda t: t + 5)],
    "blank_currency": [(1, "currency", "")],
    "text_amount": [(5, "amount", "ten")],
}


def submission_rows(inst: str, period: str, inject: str | None = None) -> list[list[str]]:
    rows = []
    for place, code in enumerate(CODES):
        cells = {"institution_id": inst, "reporting_period": period, "line_code": code, "currency": "MYR",
                 "amount": f"{2500 + 125 * place}.75"}
        rows.append([cells[c] for c in COLUMNS])
    for edit in FAULTS.get(inject, []):
        if edit[0] == "drop":
            del rows[edit[1]]
        elif edit[0] == "repeat":
            rows.append(list(rows[edit[1]]))
        elif edit[0] != "manifest":
            rows[edit[0]][COLUMNS.index(edit[1])] = edit[2]
    return rows


def _total(rows: list[list[str]]) -> float:
    total = 0.0
    for row in rows:
        try:
            total += float(row[COLUMNS.index("amount")])
        except ValueError:
            pass
    return round(total, 2)


def write_submission(folder, inst: str, period: str, version, inject: str | None = None,
                     name: str | None = None, manifest: bool = True, bad_sha: bool = False,
                     body: bytes | None = None, rows: list[list[str]] | None = None) -> str:
    """Write a file and its manifest; returns the file's path.

    ``rows`` replaces the rows of the file and of its manifest's counts;
    ``body`` only the bytes of the file.
    """
    rows = submission_rows(inst, period, inject) if rows is None else rows
    text = "".join(line + "\n" for line in [HEADER, *map(",".join, rows)])
    data = text.encode() if body is None else body
    path = Path(folder) / (name or f"{inst}_LCR_{period}_v{version}.csv")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)
    if manifest:
        says = {"sha256": hashlib.sha256(b"other" if bad_sha else data).hexdigest(), "record_count": len(rows),
                "control_total": _total(rows), "file_name": path.name, "institution_id": inst,
                "reporting_period": period, "return_type": "LCR", "synthetic": True, "version": version,
                "generated_at": f"{period}-28T09:30:00+00:00"}
        for edit in FAULTS.get(inject, []):
            if edit[0] == "manifest":
                says[edit[1]] = edit[2](says[edit[1]])
        path.with_name(path.name + ".manifest.json").write_text(json.dumps(says))
    return str(path)
