"""Structural validation of files too large for one task (C1-C9, splittable path).

The whole-file path (``structure.validate``) holds a file in one row.  A
single submission that carries a large share of all rows must instead be read
as a splittable text scan, which loses record numbers.  They are recovered
exactly without shuffling the lines:

1. each scan partition numbers its lines per (file, block) in order and counts
   quote characters, and the records that start in the block, both for a block
   that begins inside a quoted field and for one that does not (an Arrow batch
   pass, no shuffle);
2. the per-block counts (one row per block) give, per file, whether a block
   begins inside quotes and the records before it (windows over the blocks of
   a file only);
3. lines join that small block table; only the lines of a record that spans
   several and closes are gathered, per record.  A file with an odd number of
   quotes ends in a record that does not close: it is an error by its place,
   and its lines, which may be most of the file, stay apart.

Per-file results (record count, control total, error count) are partial
aggregates.  Errors are numbered within their block, after the errors of
earlier blocks, so no file's errors are ever sorted in one task.  Verdicts
equal those of the whole-file path (tested); files must be non-empty.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakepipe.contracts import Contract
from lakepipe.functions.columns import NUMBER_PATTERN
from lakepipe.functions.joins import checked_broadcast
from lakepipe.operators.structure import (MAX_LEDGER_ERRORS, MAX_REPORT_ERRORS, NOT_UTF8, _amount_value,
                                          _cell_errors, _cells, _py_list, _strip, split_fields, unclosed_error)
from lakepipe.sources.tables import stage

# The line travels as binary: Python never decodes it (invalid UTF-8 is detected JVM-side).
NUMBERED = "path string, block long, pos long, quotes_upto long, starts0 long, starts1 long, quotes long, vb binary"
MAX_BLOCK_ROWS = 200_000
BOM = "\ufeff"


def _number_partition(batches):
    """Line position, quote characters so far and record starts so far per (file, block), in scan order.

    ``starts1`` counts as if the block began inside a quoted field.
    """
    last, carry = None, {}
    for pdf in batches:
        if pdf.empty:
            continue
        key = pdf["path"] + "\x00" + pdf["block"].astype(str)
        new = key.ne(key.shift())
        new.iloc[0] = key.iloc[0] != last
        seg = new.cumsum()
        first = (seg == seg.iloc[0]).to_numpy() if not new.iloc[0] else None   # goes on from the last batch

        def running(values, name):
            total = values.groupby(seg).cumsum().to_numpy(dtype="int64")
            if first is not None:
                total[first] += carry[name]
            carry[name] = int(total[-1])
            return total

        pos = running(pd.Series(1, index=pdf.index), "pos") - 1
        upto = running(pdf["quotes"].astype("int64"), "quotes")
        outside = (upto - pdf["quotes"].to_numpy(dtype="int64")) % 2 == 0
        full = pdf["nonempty"].to_numpy(dtype=bool)
        out = {"path": pdf["path"], "block": pdf["block"], "pos": pos, "quotes_upto": upto,
               "starts0": running(pd.Series((full & outside).astype("int64"), index=pdf.index), "starts0"),
               "starts1": running(pd.Series((full & ~outside).astype("int64"), index=pdf.index), "starts1"),
               "quotes": pdf["quotes"], "vb": pdf["vb"]}
        last = key.iloc[-1]
        yield pd.DataFrame(out)


def numbered_records(spark: SparkSession, paths) -> DataFrame:
    """path, block, line (1-based physical line of its start), record (number among non-empty ones), value, unclosed; staged.

    ``unclosed`` is 1 for the first line of a record that does not close, 2 for its other lines, otherwise 0.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = stage(spark, spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        (~F.col("value").isin("", "\r")).alias("nonempty"), quotes.cast("long").alias("quotes"),
        F.col("value").cast("binary").alias("vb")).mapInPandas(_number_partition, NUMBERED), "numbered-lines")
    blocks = lines.groupBy("path", "block").agg(
        F.count(F.lit(1)).alias("n"), F.max("quotes_upto").alias("q"), F.max("starts0").alias("s0"), F.max("starts1").alias("s1"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    offsets = (blocks.withColumn("inside", so_far("q") % 2)
               .withColumn("s", F.when(F.col("inside") == 0, F.col("s0")).otherwise(F.col("s1")))
               .select("path", "block", "inside", so_far("n").alias("lines_before"), so_far("s").alias("starts_before"),
                       F.when(F.sum("q").over(Window.partitionBy("path")) % 2 == 1, F.sum("s").over(Window.partitionBy("path")))
                       .alias("unclosed_record")))
    j = lines.join(checked_broadcast(offsets, MAX_BLOCK_ROWS), ["path", "block"])
    starts = F.when(F.col("inside") == 0, F.col("starts0")).otherwise(F.col("starts1"))
    j = j.select("path", "block", (F.col("lines_before") + F.col("pos") + 1).alias("line"),
                 (F.col("starts_before") + starts).alias("record"),
                 ((F.col("inside") + F.col("quotes_upto") - F.col("quotes")) % 2 == 1).alias("goes_on"),
                 ((F.col("inside") + F.col("quotes_upto")) % 2 == 1).alias("open"),
                 F.col("vb").cast("string").alias("value"), "unclosed_record")
    whole = F.col("goes_on") | F.col("open")
    part = F.when(whole & (F.col("record") == F.col("unclosed_record")), F.when(F.col("goes_on"), 2).otherwise(1)).otherwise(0)
    j = j.withColumn("unclosed", part)
    spans = (j.where(whole & (F.col("unclosed") == 0)).groupBy("path", "record")
             .agg(F.array_sort(F.collect_list(F.struct("line", "value", "block"))).alias("parts"))
             .select("path", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["line"].alias("line"), "record",
                     F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"), F.lit(0).alias("unclosed")))
    every = j.where(~whole | (F.col("unclosed") > 0)).select("path", "block", "line", "record", "value", "unclosed").unionByName(spans)
    # cut by length: a regular expression would repair bytes that are not UTF-8
    cr = F.endswith("value", F.lit("\r"))
    return every.withColumn("value", F.when(cr, F.substr("value", F.lit(1), F.length("value") - 1)).otherwise(F.col("value")))


def _headers(records: DataFrame, contract: Contract, delimiter: str, marks: DataFrame | None) -> DataFrame:
    """Per file: header fields, and the position of each contract column in it.

    The text scan strips a byte-order mark; ``marks`` (path, bom) tells which
    files have one, as it belongs to the first name.
    """
    first = records.where(F.col("line") == 1)
    if marks is not None:
        first = first.join(marks.select("path", "bom"), "path", "left").withColumn(
            "value", F.when(F.col("bom"), F.concat(F.lit(BOM), F.col("value"))).otherwise(F.col("value")))
    first = first.select("path", F.when((F.col("value") == "") | (F.col("unclosed") == 1), F.array().cast("array<string>"))
                         .otherwise(split_fields(F.col("value"), delimiter)).alias("header"),
                         (F.col("value") != "").cast("long").alias("header_nonempty"))
    hdr, cols = F.col("header"), []
    for name in contract.column_names:
        rev = F.array_position(F.reverse(hdr), F.lit(name)).cast("int")
        cols.append(F.when(rev > 0, F.size(hdr) - rev + 1).otherwise(F.lit(0)).alias(f"__i_{name}"))
    return first.select("path", "header", "header_nonempty", *cols)


def validate_large(spark: SparkSession, paths, manifests: DataFrame, contract: Contract,
                   delimiter: str = ",", max_files: int = 200_000, records: DataFrame | None = None):
    """Validate (possibly huge) files by splittable scan.

    ``manifests``: path, manifest (struct with record_count, control_total)
    and, if known, bom (the file begins with a byte-order mark).
    Returns (summary, errors): one row per file (record_count, control_total,
    n_errors, status, reason) and all errors of each file (path, error_no,
    message).
    """
    expected = contract.column_names
    # staged: several aggregates below read the records; scan and numbering run once
    nl = records if records is not None else stage(spark, numbered_records(spark, paths), "records")
    headers = _headers(nl, contract, delimiter, manifests if "bom" in manifests.columns else None).withColumn(
        "header_ok", F.col("header") == F.array(*[F.lit(c) for c in expected]))
    headers = checked_broadcast(headers, max_files)
    idx = {name: F.col(f"__i_{name}") for name in expected}

    data = nl.where((F.col("line") >= 2) & (F.col("value") != "") & (F.col("unclosed") < 2)).join(headers, "path")
    n = (F.col("record") - F.col("header_nonempty") + 1)
    data = data.withColumn("__f", split_fields(F.col("value"), delimiter))
    cells = _cells(contract, F.col("__f"), idx)
    rows = data.select("path", "block", n.alias("n"), cells.alias("c"), "line", (F.col("unclosed") == 1).alias("unclosed"))
    rows = rows.select("path", "block", "n",
                       F.when(F.col("unclosed"), F.array(unclosed_error(F.col("n"), F.col("line"))))
                       .otherwise(_cell_errors(contract, F.col("c"), F.col("n"))).alias("errs"),
                       F.when(~F.col("unclosed"), _amount_value(contract, F.col("c"))).alias("amt"))
    rows = stage(spark, rows, "line-checks")     # per-file totals, block counts and errors read it

    zero = F.lit(0).cast("decimal(38,6)")
    bad_utf8 = nl.groupBy("path").agg(F.count_if(~F.is_valid_utf8("value")).alias("bad_lines"))
    per_file = rows.groupBy("path").agg(F.count(F.lit(1)).alias("record_count"),
                                        F.coalesce(F.sum("amt"), zero).cast("decimal(38,6)").alias("control_total"),
                                        F.sum(F.size("errs")).alias("line_errors"))
    files = headers.select("path", "header", "header_ok").join(per_file, "path", "left").join(
        manifests.select("path", "manifest"), "path", "left").join(bad_utf8, "path", "left")
    files = files.select("path", "header", "header_ok", "manifest", (F.col("bad_lines") > 0).alias("not_utf8"),
                         F.coalesce("record_count", F.lit(0)).cast("long").alias("record_count"),
                         F.coalesce("control_total", zero).alias("control_total"),
                         F.coalesce("line_errors", F.lit(0)).cast("long").alias("line_errors"))
    m = F.col("manifest")
    total2 = F.round(F.col("control_total"), 2)
    header_err = F.when(~F.col("header_ok"), F.concat(F.lit("header "), _py_list(F.col("header")),
                                                      F.lit(" != contract "),
                                                      _py_list(F.array(*[F.lit(c) for c in expected]))))
    count_err = F.when(m.isNull(), F.lit("manifest missing")).when(
        F.col("record_count") != m["record_count"],
        F.concat(F.lit("record count "), F.col("record_count").cast("string"), F.lit(" != manifest "),
                 m["record_count"].cast("string")))
    total_err = F.when(m.isNotNull() & (F.abs(total2.cast("double") - m["control_total"]) > 0.01),
                       F.concat(F.lit("control total "), total2.cast("decimal(38,2)").cast("string"),
                                F.lit(" != manifest "), m["control_total"].cast("decimal(38,2)").cast("string")))
    files = files.select("path", "record_count", "control_total", "not_utf8", "line_errors",
                         header_err.alias("e_header"), count_err.alias("e_count"), total_err.alias("e_total"))
    # bytes that are not UTF-8: one error, nothing else is reported (as the whole-file path)
    none = F.lit(None).cast("string")
    files = files.select("path", F.when(F.col("not_utf8"), F.lit(0)).otherwise(F.col("record_count")).alias("record_count"),
                         F.when(F.col("not_utf8"), zero).otherwise(F.col("control_total")).alias("control_total"), "not_utf8",
                         F.when(F.col("not_utf8"), F.lit(0)).otherwise(F.col("line_errors")).alias("line_errors"),
                         F.when(F.col("not_utf8"), F.lit(NOT_UTF8)).otherwise(F.col("e_header")).alias("e_header"),
                         F.when(F.col("not_utf8"), none).otherwise(F.col("e_count")).alias("e_count"),
                         F.when(F.col("not_utf8"), none).otherwise(F.col("e_total")).alias("e_total"))
    n_err = (F.col("line_errors") + F.col("e_header").isNotNull().cast("long")
             + F.col("e_count").isNotNull().cast("long") + F.col("e_total").isNotNull().cast("long"))
    summary = files.select(
        "path", "record_count", "control_total", n_err.alias("n_errors"),
        F.when(n_err == 0, F.lit("VALIDATED")).otherwise(F.lit("REJECTED")).alias("status"),
        F.when(n_err > 0, F.concat(n_err.cast("string"), F.lit(" structural errors"))).alias("reason"))

    # an error's number: the header error, the errors of earlier blocks, its place in its own block
    blk = rows.groupBy("path", "block").agg(F.sum(F.size("errs")).alias("k"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blk = blk.select("path", "block", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("kb"))
    known = files.where(~F.col("not_utf8")).select("path", F.col("e_header").isNotNull().cast("long").alias("head"))
    inner = rows.where(F.size("errs") > 0).select(
        "path", "block", "n", F.inline(F.transform("errs", lambda e, i: F.struct(i.alias("k"), e.alias("message")))))
    inner = (inner.join(checked_broadcast(blk, MAX_BLOCK_ROWS), ["path", "block"])
             .join(checked_broadcast(known, max_files), "path"))
    place = F.row_number().over(Window.partitionBy("path", "block").orderBy("n", "k"))
    line_errs = inner.select("path", (F.col("head") + F.col("kb") + place).alias("error_no"), "message")
    lead = F.when(F.col("e_header").isNotNull(), 1).otherwise(0)
    tail = lead + F.col("line_errors")
    file_errs = files.select("path", F.inline(F.array(
        F.struct(F.lit(1).cast("long").alias("error_no"), F.col("e_header").alias("message")),
        F.struct((tail + 1).alias("error_no"), F.col("e_count").alias("message")),
        F.struct((tail + 1 + F.col("e_count").isNotNull().cast("long")).alias("error_no"), F.col("e_total").alias("message"))))
    ).where(F.col("message").isNotNull())
    errors = line_errs.unionByName(file_errs).select("path", F.col("error_no").cast("int").alias("error_no"), "message")
    return summary, errors


def parse_large(spark: SparkSession, paths, contract: Contract, delimiter: str = ",",
                max_files: int = 200_000, records: DataFrame | None = None) -> DataFrame:
    """Typed rows of large files (A3 on the splittable path): path, line_no, contract columns."""
    nl = records if records is not None else numbered_records(spark, paths)
    headers = checked_broadcast(_headers(nl, contract, delimiter, None).drop("header"), max_files)
    data = nl.where((F.col("line") >= 2) & (F.col("value") != "") & (F.col("unclosed") < 2)).join(headers, "path")
    data = data.withColumn("__f", split_fields(F.col("value"), delimiter))
    out = [F.col("path"), (F.col("record") - F.col("header_nonempty") + 1).cast("int").alias("line_no")]
    for p in contract.properties:
        pos = F.col(f"__i_{p.name}")
        v = F.when(pos > 0, F.try_element_at("__f", pos))
        if p.logical_type == "number":
            v = F.when(_strip(v).rlike(NUMBER_PATTERN), _strip(v).try_cast("decimal(20,2)"))
        out.append(F.when(F.col("unclosed") == 0, v).alias(p.name))
    return data.select(*out)


def report_rows(summary: DataFrame, errors: DataFrame) -> DataFrame:
    """Large-file results in the whole-file shape: errors (<=200) and detail_errors (<=20) arrays."""
    arr = errors.where(F.col("error_no") <= MAX_REPORT_ERRORS).groupBy("path").agg(F.array_sort(F.collect_list(F.struct("error_no", "message"))).alias("e"))
    msgs = F.transform(F.coalesce(F.col("e"), F.array().cast("array<struct<error_no:int,message:string>>")),
                       lambda x: x["message"])
    return summary.join(arr, "path", "left").select(
        "path", "record_count", "control_total", "n_errors", "status", "reason",
        msgs.alias("errors"), F.slice(msgs, 1, MAX_LEDGER_ERRORS).alias("detail_errors"))
