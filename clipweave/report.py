"""Small reports of bounded results: cards, review tables, thresholds."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame

from clipweave.operators.rules import Rule

MOST_ROWS = 10_000


def bounded(df: DataFrame, most: int = MOST_ROWS) -> list[dict]:
    """The rows of a report; more than `most` is an error, not a cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    return [r.asDict(recursive=True) for r in rows]


def review_table(df: DataFrame) -> str:
    """Rows as an HTML table, every value escaped; null is empty."""
    rows = bounded(df)
    head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
    body = "".join("<tr>" + "".join(f"<td>{'' if r[c] is None else html.escape(str(r[c]))}</td>" for c in df.columns) + "</tr>" for r in rows)
    return f"<table><tr>{head}</tr>{body}</table>"


def dataset_card(title: str, splits: DataFrame, notes: str = "") -> str:
    """A Markdown card: a table of splits (split, clips, hours, speakers), then notes."""
    rows = sorted(bounded(splits), key=lambda r: str(r["split"]))
    lines = [f"# {title}", "", "| split | clips | hours | speakers |", "|-|-|-|-|"]
    lines += [f"| {r['split']} | {r['clips']:,} | {r['hours']:.2f} | {r['speakers']:,} |" for r in rows]
    return "\n".join([*lines, "", notes]).rstrip() + "\n"


def thresholds_yaml(rules: tuple[Rule, ...]) -> str:
    """The limits of a set of rules as settings; null is off."""
    return "filter:\n" + "".join(f"  {r.side}_{r.metric}: {'null' if r.limit is None else r.limit}\n" for r in rules)


def export_figures(figures: dict[str, DataFrame], folder: str) -> list[str]:
    """The data of figures, a table and a JSON document each, for whatever draws them; returns the names written. Figures are small by nature: groups,
    bins or a top-k."""
    import json
    from pathlib import Path

    out = Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    for name, df in figures.items():
        rows = [json.loads(r) for r in df.toJSON().collect()]
        (out / f"{name}.json").write_text(json.dumps({"columns": df.columns, "rows": rows}, ensure_ascii=False), encoding="utf-8")
        (out / f"{name}.html").write_text(f"<meta charset='utf-8'><h1>{html.escape(name)}</h1>{review_table(df)}", encoding="utf-8")
    return sorted(figures)


def tuner_document(payload: DataFrame, rules: tuple, clips: DataFrame, *, most: int = 30_000, key: str = "id") -> dict:
    """What a threshold tuner shows: the rules with their limits, the range of every metric, and up to `most` clips in seeded order."""
    from clipweave.operators.select import seeded_sample

    metrics = [r["metric"] for r in payload.select("metric").collect()]
    sample = seeded_sample(clips.select(key, "video_id", "start_sec", *metrics), most, key)
    return {
        "rules": [{"metric": r.metric, "side": r.side, "limit": r.limit, "reason": r.reason} for r in rules],
        "metrics": [r.asDict() for r in payload.collect()],
        "clips": [r.asDict() for r in sample.collect()],
    }
