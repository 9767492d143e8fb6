"""What a query does, read off its own plan: so a note can't say what the query doesn't do."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame


def _seq(of) -> list:
    return [of.apply(i) for i in range(of.size())]


def _conjuncts(condition) -> Iterator:
    if condition.nodeName() == "And":
        for child in _seq(condition.children()):
            yield from _conjuncts(child)
    else:
        yield condition


def _text(expression) -> str:
    """An expression as SQL, without the names of what its columns come from and the brackets around it."""
    text = expression.sql().replace("`", "")
    parts = []
    for word in text.replace("(", "( ").split(" "):
        parts.append(word.rpartition(".")[2] if "." in word and not word.replace(".", "").replace("D", "").isdigit() and "'" not in word else word)
    text = " ".join(parts).replace("( ", "(")
    depth = [text[: i + 1].count("(") - text[: i + 1].count(")") for i in range(len(text) - 1)]
    return text[1:-1] if text[:1] == "(" and text[-1:] == ")" and all(depth) else text


def plan_notes(df: DataFrame, views: list[str]) -> list[str]:
    """`view: name` of the views that are read, `where: condition` of each filter on them, `within: condition` of each that the
    views have inside (gates too), `by: columns` of aggregations, `window: frame`, `order: ...` and `limit: n`."""
    notes: list[str] = []

    def add(note: str) -> None:
        if note not in notes:
            notes.append(note)

    def walk(node, inside: bool) -> None:
        name = node.nodeName()
        if name == "SubqueryAlias" and node.identifier().name() in views:
            if not inside:
                add(f"view: {node.identifier().name()}")
            inside = True
        elif name == "Filter":
            for c in _conjuncts(node.condition()):
                add(f"{'within' if inside else 'where'}: {_text(c)}")
        elif name == "Aggregate" and not inside:
            add("by: " + (", ".join(_text(g) for g in _seq(node.groupingExpressions())) or "all rows"))
        elif name == "Window":
            for spec in {e for e in _frames(node)}:
                add(f"window: {spec}")
        elif name == "Sort" and not inside:
            add("order: " + ", ".join(_text(o) for o in _seq(node.order())))
        elif name == "GlobalLimit":
            add(f"limit: {_text(node.limitExpr())}")
        for child in _seq(node.children()):
            walk(child, inside)

    def _frames(node) -> Iterator[str]:
        for e in _seq(node.windowExpressions()):
            text = e.sql().replace("`", "")
            yield text[text.index(" OVER ") + 6 : text.rindex(")") + 1].partition("ORDER BY ")[2].partition(" ")[2].rstrip(")").replace("ASC NULLS FIRST ", "")

    walk(df._jdf.queryExecution().analyzed(), False)
    return sorted(notes, key=lambda n: ["view", "where", "within", "by", "window", "order", "limit"].index(n.partition(":")[0]))
