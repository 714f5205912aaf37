"""Structural validation of submission files against the data contract.

A submission file is one row (the raw scan reads each file whole), so the
whole check is a projection with array functions over that row: split into
records, map header names to positions, test every cell, count records, sum
the control column.  No shuffle, no driver-side parsing, files validate in
parallel across tasks.  A file too large for one task takes the splittable
path (``structure_large``), which gives the same verdicts.

What both paths hold to: records end at a line feed, with or without a
carriage return before it; a quoted field may hold delimiters, doubled quotes
and line feeds; a byte-order mark is part of the first header name; blank
records are not counted.  A quote that is never closed makes the rest of the
file one record, counted, with one error that tells its place and no cells (a
header that does not close has no names).

Deviations from a Python ``float()`` check (deliberate): ``1_000``, ``nan``
and ``inf`` are not numbers.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepipe.contracts import Contract
from lakepipe.functions.columns import NUMBER_PATTERN

NOT_UTF8 = "file is not valid UTF-8"
# What the report and the ledger show of a file's errors (the error table holds all),
# and the wording of the messages below.
MAX_REPORT_ERRORS = 200
MAX_LEDGER_ERRORS = 20
_WS = r"^\s+|\s+$"


def split_records(content: Column) -> Column:
    """Records of a text as array<string>, the line ends removed.

    Without a quote character this is a plain split; otherwise a line feed
    inside a quoted field does not end the record.
    """
    runs = F.regexp_extract_all(content, F.lit(r'((?:[^"\n]++|"[^"]*+"?)*+)(?:\n|\z)'), F.lit(1))
    return (F.when(content.contains('"'), F.transform(runs, lambda r: F.regexp_replace(r, r"\r\z", "")))
            .otherwise(F.split(content, r"\r?\n", -1)))


def split_fields(line: Column, delimiter: str = ",") -> Column:
    """CSV fields of one record as array<string>.

    Records without a quote character take the plain split.  Quoted ones are
    tokenised with a regular expression (a delimiter, then a quoted run with
    doubled quotes and what follows it, or a run without the delimiter), then
    unquoted, as a CSV reader does.
    """
    d = re.escape(delimiter)
    token = f'{d}("(?:[^"]++|"")*+"[^{d}]*+|[^{d}]*+)'
    quoted = r'(?s)^"((?:[^"]++|"")*+)"(.*)$'

    def unquote(x):
        inner = F.regexp_replace(F.regexp_extract(x, quoted, 1), '""', '"')
        return F.when(x.rlike(quoted), F.concat(inner, F.regexp_extract(x, quoted, 2))).otherwise(x)
    tokens = F.regexp_extract_all(F.concat(F.lit(delimiter), line), F.lit(token), F.lit(1))
    return F.when(line.contains('"'), F.transform(tokens, unquote)).otherwise(F.split(line, d, -1))


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, _WS, "")


def _py_list(arr: Column) -> Column:
    """Render an array of strings like Python's list repr: ['a', 'b']."""
    return F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'"))),
                                             ", "), F.lit("]"))


def _cells(contract: Contract, fields: Column, idx: dict[str, Column]) -> Column:
    """One record's fields -> struct of stripped cell values by contract property."""
    vals = []
    for p in contract.properties:
        raw = F.when(idx[p.name] > 0, F.try_element_at(fields, idx[p.name]))
        vals.append(_strip(F.coalesce(raw, F.lit(""))).alias(p.name))
    return F.struct(*vals)


def _cell_errors(contract: Contract, cells: Column, n: Column) -> Column:
    """Error messages of one record, in contract property order (NULLs removed)."""
    out = []
    line = F.concat(F.lit("line "), n.cast("string"), F.lit(": "))
    for p in contract.properties:
        v = cells[p.name]
        missing = (v == "") if p.required else F.lit(False)
        if p.required:
            out.append(F.when(missing, F.concat(line, F.lit(f"{p.name} is required"))))
        if p.logical_type == "number":
            out.append(F.when(~missing & ~v.rlike(NUMBER_PATTERN),
                              F.concat(line, F.lit(f"{p.name}='"), v, F.lit("' is not a number"))))
        if p.pattern:
            out.append(F.when(~missing & (v != "") & ~v.rlike(f"^(?:{p.pattern})"),
                              F.concat(line, F.lit(f"{p.name}='"), v,
                                       F.lit(f"' does not match {p.pattern}"))))
    return F.filter(F.array(*out), lambda e: e.isNotNull())


def unclosed_error(n: Column, line: Column) -> Column:
    """Message for a record, number ``n``, whose quote is not closed; ``line`` is the line of the file where it starts."""
    return F.concat(F.lit("line "), n.cast("string"), F.lit(": quote not closed in the record that starts in line "),
                    line.cast("string"), F.lit(" of the file"))


def _amount_value(contract: Contract, cells: Column) -> Column:
    """Parsable value of the ``amount`` property of one record (NULL otherwise)."""
    if not any(p.name == "amount" and p.logical_type == "number" for p in contract.properties):
        return F.lit(None).cast("decimal(38,6)")
    v = cells["amount"]
    return F.when(v.rlike(NUMBER_PATTERN), v.try_cast("decimal(38,6)"))


def validate(files: DataFrame, contract: Contract, content: str = "content",
             manifest: str = "manifest", delimiter: str = ",") -> DataFrame:
    """Add the structural verdict to every file row.

    Input columns: ``content`` (decoded text) and ``manifest`` (struct with
    ``record_count`` and ``control_total``, NULL when missing).  Added:
    ``record_count, control_total, header_ok, n_errors, all_errors, errors``
    (first 200), ``detail_errors`` (first 20), ``status``, ``reason``.
    """
    expected = contract.column_names
    lines = split_records(F.col(content))
    first = F.element_at(lines, 1)
    # a file with an odd number of quotes ends in a record that does not close, its last one that is not blank
    odd = F.regexp_count(F.col(content), F.lit('"')) % 2 == 1
    last = F.element_at(F.filter(lines, lambda x: x != ""), -1)
    line_feeds = lambda c: F.regexp_count(c, F.lit("\n"))
    df = files.withColumn("__unclosed_line", F.when(odd, line_feeds(F.col(content)) - line_feeds(last) + 1))
    df = df.withColumn("__header", F.when((first == "") | (F.col("__unclosed_line") == 1), F.array().cast("array<string>"))
                          .otherwise(split_fields(first, delimiter)))
    hdr = F.col("__header")
    idx = {}
    for name in expected:
        rev = F.array_position(F.reverse(hdr), F.lit(name)).cast("int")
        df = df.withColumn(f"__i_{name}", F.when(rev > 0, F.size(hdr) - rev + 1).otherwise(F.lit(0)))
        idx[name] = F.col(f"__i_{name}")
    records = F.filter(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: x != "")
    fields = F.transform(records, lambda r: split_fields(r, delimiter))      # split each record once
    df = df.withColumn("__cells", F.transform(fields, lambda f: _cells(contract, f, idx)))
    cells = F.col("__cells")
    zero = F.lit(0).cast("decimal(38,6)")
    unclosed = lambda i: F.col("__unclosed_line").isNotNull() & (i == F.size(cells) - 1)
    df = (df.withColumn("record_count", F.size(cells).cast("long"))
            .withColumn("control_total", F.aggregate(F.transform(cells, lambda c, i: F.when(~unclosed(i), _amount_value(contract, c))),
                                                     zero, lambda acc, x: acc + F.coalesce(x, zero)))
            .withColumn("header_ok", hdr == F.array(*[F.lit(c) for c in expected])))
    m = F.col(manifest)
    # an empty file has no header row at all (rendered None); a blank first line is []
    shown = F.when(F.col(content) == "", F.lit("None")).otherwise(_py_list(hdr))
    header_err = F.when(~F.col("header_ok"), F.concat(F.lit("header "), shown, F.lit(" != contract "),
                                                      _py_list(F.array(*[F.lit(c) for c in expected]))))
    count_err = F.when(m.isNull(), F.lit("manifest missing")).when(
        F.col("record_count") != m["record_count"],
        F.concat(F.lit("record count "), F.col("record_count").cast("string"),
                 F.lit(" != manifest "), m["record_count"].cast("string")))
    total2 = F.round(F.col("control_total"), 2)
    total_err = F.when(m.isNotNull() & (F.abs(total2.cast("double") - m["control_total"]) > 0.01),
                       F.concat(F.lit("control total "), total2.cast("decimal(38,2)").cast("string"),
                                F.lit(" != manifest "),
                                m["control_total"].cast("decimal(38,2)").cast("string")))
    all_errors = F.concat(F.filter(F.array(header_err), lambda e: e.isNotNull()),
                          F.flatten(F.transform(cells, lambda c, i: F.when(unclosed(i), F.array(unclosed_error(i + 2, F.col("__unclosed_line"))))
                                                .otherwise(_cell_errors(contract, c, i + 2)))),
                          F.filter(F.array(count_err, total_err), lambda e: e.isNotNull()))
    if "utf8_ok" in files.columns:
        # bytes that are not UTF-8 are not decoded at all: one error, nothing parsed
        all_errors = F.when(F.col("utf8_ok") == F.lit(False), F.array(F.lit(NOT_UTF8))).otherwise(all_errors)
    df = df.withColumn("all_errors", all_errors)
    n = F.size("all_errors")
    return (df.withColumn("n_errors", n.cast("long"))
              .withColumn("errors", F.slice("all_errors", 1, MAX_REPORT_ERRORS))
              .withColumn("detail_errors", F.slice("all_errors", 1, MAX_LEDGER_ERRORS))
              .withColumn("status", F.when(n == 0, F.lit("VALIDATED")).otherwise(F.lit("REJECTED")))
              .withColumn("reason", F.when(n > 0, F.concat(n.cast("string"), F.lit(" structural errors"))))
              .drop("__header", "__cells", "__unclosed_line", *[f"__i_{c}" for c in expected]))


def report(validated: DataFrame) -> DataFrame:
    """Validation report rows: {submission_id, raw_key, status, errors[<=200]} (A10)."""
    return validated.select("submission_id", "raw_key", "status", "errors")


def error_rows(validated: DataFrame) -> DataFrame:
    """One row per error, all of them, numbered in report order.

    ``inline(transform(...))`` rather than ``posexplode``: exploding an array
    built by higher-order functions re-evaluated it per output row (40x slower
    at sf0.01).
    """
    numbered = F.transform("all_errors", lambda e, i: F.struct((i + 1).alias("error_no"), e.alias("message")))
    return validated.select("submission_id", F.inline(numbered))


def parse_records(validated: DataFrame, contract: Contract, content: str = "content",
                  delimiter: str = ",", keep: tuple[str, ...] = ("submission_id", "raw_key", "sha256")
                  ) -> DataFrame:
    """Typed Bronze rows of validated files (A3): one row per data record.

    Columns are looked up by header name (not trimmed, as the loader reads
    them); ``amount`` becomes decimal(20,2) rounding HALF_UP; unparsable cells
    become NULL and are caught by the rule engine.
    """
    lines = split_records(F.col(content))
    hdr = split_fields(F.element_at(lines, 1), delimiter)
    df = validated.withColumn("__header", hdr)
    pos = {}
    for p in contract.properties:
        rev = F.array_position(F.reverse(F.col("__header")), F.lit(p.name)).cast("int")
        df = df.withColumn(f"__i_{p.name}", F.when(rev > 0, F.size("__header") - rev + 1).otherwise(0))
        pos[p.name] = F.col(f"__i_{p.name}")

    def typed(fields, i):
        vals = [(i + 2).alias("line_no")]
        for p in contract.properties:
            v = F.when(pos[p.name] > 0, F.try_element_at(fields, pos[p.name]))
            if p.logical_type == "number":
                v = F.when(_strip(v).rlike(NUMBER_PATTERN), _strip(v).try_cast("decimal(20,2)"))
            vals.append(v.alias(p.name))
        return F.struct(*vals)

    records = F.filter(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: x != "")
    # exploded records are split once each; a lambda over the array would split once per property
    rows = df.select(*keep, *[f"__i_{p.name}" for p in contract.properties], F.posexplode(records).alias("__n", "__rec"))
    rows = rows.withColumn("__fields", split_fields(F.col("__rec"), delimiter))
    return rows.select(*keep, F.inline(F.array(typed(F.col("__fields"), F.col("__n")))))
