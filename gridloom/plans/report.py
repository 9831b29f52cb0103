"""A self-contained page that shows the tables of a run."""

from __future__ import annotations

import html
import json

from pyspark.sql import functions as F

from ..operators.windows import top_n

PAGE = """<!doctype html><html lang="en"><head><meta charset="utf-8"><meta http-equiv="Content-Security-Policy" content="default-src 'none'; style-src 'unsafe-inline'; script-src 'unsafe-inline'">
<title>Tables</title><style>body{{font:14px sans-serif;margin:2em}}table{{border-collapse:collapse;margin:.5em 0 2em}}td,th{{border:1px solid #bbb;padding:2px 6px}}th{{background:#eee}}</style></head>
<body><h1>Tables</h1><p>Filter: <input id="f" placeholder="text"></p>{body}
<script type="application/json" id="data">{data}</script>
<script>document.getElementById("f").oninput=e=>{{const t=e.target.value.toLowerCase();document.querySelectorAll("tbody tr").forEach(r=>r.hidden=!r.textContent.toLowerCase().includes(t))}}</script></body></html>
"""


def script_json(value) -> str:
    """JSON that cannot end its script element."""
    text = json.dumps(value, sort_keys=True, ensure_ascii=False, default=str)
    for plain in "&<>  ":
        text = text.replace(plain, f"\\u{ord(plain):04x}")
    return text


def html_report(run, settings) -> str:
    """The first ``preview_rows`` rows and ``preview_columns`` columns of each
    table, by values and by formulas; the previews are ranked and cut by the
    executors."""
    key = ["workbook", "table_id"]
    cell = F.struct("col", "label", F.coalesce("value", F.lit("")).alias("value"), F.coalesce("formula", F.lit("")).alias("formula"))
    rows = run.clean.groupBy(*key, "row").agg(F.slice(F.array_sort(F.collect_list(cell)), 1, settings.preview_columns).alias("cells"))
    by: dict[tuple, list] = {}
    for r in top_n(rows, key, [F.col("row")], settings.preview_rows).orderBy(*key, "row").toLocalIterator():
        by.setdefault((r["workbook"], r["table_id"]), []).append(r["cells"])
    index = [r.asDict() for r in run.tables.select("workbook", "sheet", "range", "table_id", "title", "confidence", "decision").orderBy("workbook", "sheet", "range").collect()]
    body = []
    for t in index:
        shown = by.get((t["workbook"], t["table_id"]), [])
        head = "".join(f"<th>{html.escape(x['label'])}</th>" for x in (shown[0] if shown else []))
        lines = "".join("<tr>" + "".join(f"<td title={_quoted(x['formula'])}>{html.escape(x['value'])}</td>" for x in r) + "</tr>" for r in shown)
        name = " ".join(filter(None, (t["sheet"], t["range"], t["title"])))
        body.append(f"<h2>{html.escape(name)}</h2><table><thead><tr>{head}</tr></thead><tbody>{lines}</tbody></table>")
    return PAGE.format(body="".join(body), data=script_json(index))


def _quoted(text: str) -> str:
    return '"' + html.escape(text, quote=True) + '"'
