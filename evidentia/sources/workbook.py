"""Spreadsheets and vote lists: rows of workbooks (XLSX), and links of listing pages."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
FLAGS = ["ja", "nein", "Enthaltung", "nichtabgegeben", "ungültig"]


def sheet_rows(content: bytes) -> list[dict[str, str | None]]:
    """The first sheet's rows by the first row's names; formulas are an error, as their values can't be trusted."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml"))]
        sheet = ET.fromstring(z.read("xl/worksheets/sheet1.xml"))
    table = []
    for row in sheet.iterfind(".//m:row", _NS):
        cells = {}
        for cell in row.iterfind("m:c", _NS):
            if cell.find("m:f", _NS) is not None:
                raise ValueError("the sheet has formulas")
            column = re.match(r"[A-Z]+", cell.get("r", ""))[0]
            value = cell.find("m:v", _NS)
            text = "".join(t.text or "" for t in cell.iterfind(".//m:t", _NS)) if cell.get("t") == "inlineStr" else None if value is None else shared[int(value.text)] if cell.get("t") == "s" else value.text
            cells[column] = text
        table.append(cells)
    if not table:
        return []
    names = {column: (name or "").strip() for column, name in table[0].items()}
    return [{name: cells.get(column) for column, name in names.items()} for cells in table[1:] if any(cells.values())]


def ballot_rows(files: DataFrame) -> DataFrame:
    """(path, row, sitting, ballot, group, name, choice, problem) of workbooks (path, content).

    A row must have exactly one mark; a workbook that can't be read, and a row without exactly one, has a problem.
    """

    def run(frames):
        for frame in frames:
            out = []
            for path, content in zip(frame["path"], frame["content"]):
                try:
                    for n, row in enumerate(sheet_rows(content), 2):
                        marks = [f for f in FLAGS if (row.get(f) or "0").strip() == "1"]
                        out.append((path, n, row.get("Sitzungnr"), row.get("Abstimmnr"), row.get("Fraktion/Gruppe"), f"{row.get('Vorname') or ''} {row.get('Name') or ''}".strip(), marks[0] if len(marks) == 1 else None, None if len(marks) == 1 else "not exactly one mark"))
                except (ValueError, KeyError, zipfile.BadZipFile, ET.ParseError) as e:
                    out.append((path, None, None, None, None, None, None, str(e)[:200]))
            yield pd.DataFrame(out, columns=["path", "row", "sitting", "ballot", "group", "name", "choice", "problem"]).astype({"row": "Int64"})

    return files.select("path", "content").mapInPandas(run, "path string, row int, sitting string, ballot string, group string, name string, choice string, problem string")


def ballot_problems(rows: DataFrame) -> DataFrame:
    """(rule, entity_id) of ballot rows: problems, and names that stand twice in a group."""
    bad = rows.where("problem is not null").select(F.col("problem").alias("rule"), F.concat_ws(":", "path", "row").alias("entity_id"))
    twice = rows.where("problem is null").groupBy("path", "group", "name").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("name twice").alias("rule"), F.concat_ws(":", "path", "group", "name").alias("entity_id"))
    return bad.unionByName(twice)


def group_counts(rows: DataFrame) -> DataFrame:
    """(path, group, counts of each choice)."""
    return rows.where("problem is null").groupBy("path", "group").agg(*[F.count_if(F.col("choice") == f).alias(n) for f, n in zip(FLAGS, ("yes", "no", "abstain", "absent", "invalid"))])


def vote_listing(pages: DataFrame, pattern: str = r'<a[^>]+href="([^"]+)"[^>]*>\s*(\d{1,2}\.\d{1,2}\.\d{4})\s*:?\s*([^<]*)</a>') -> DataFrame:
    """(page_id, pos, href, date, title) of listing pages (page_id, html); the pattern's groups are link, day and title."""
    found = F.regexp_extract_all("html", F.lit(pattern), F.lit(0))
    each = pages.select("page_id", F.posexplode(found).alias("pos", "part"))
    return each.select("page_id", "pos", F.regexp_extract("part", pattern, 1).alias("href"), F.try_to_date(F.regexp_extract("part", pattern, 2), "d.M.yyyy").alias("date"), F.trim(F.regexp_extract("part", pattern, 3)).alias("title"))


def reconcile(overall: DataFrame, groups: DataFrame) -> DataFrame:
    """(rule, entity_id): votes whose stated totals are not the sums of their groups (vote_id, yes, no, abstain, absent)."""
    sides = ["yes", "no", "abstain", "absent"]
    sums = groups.groupBy("vote_id").agg(*[F.sum(c).alias(f"s_{c}") for c in sides])
    both = overall.join(sums, "vote_id", "left")
    same = F.lit(True)
    for c in sides:
        same = same & F.col(c).eqNullSafe(F.col(f"s_{c}"))
    return both.where(~same).select(F.lit("totals differ").alias("rule"), F.col("vote_id").cast("string").alias("entity_id"))
