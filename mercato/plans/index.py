"""Markdown index of the registered queries and the SURVEY §2 IDs they cover.

    python -m mercato.plans.index > QUERIES.md
"""

from __future__ import annotations

import re


def expand(covers: str) -> list[str]:
    """'N1-N13 A19 X1' -> ['N1', ..., 'N13', 'A19', 'X1']."""
    out = []
    for tok in re.findall(r"[A-Z]\d+(?:-[A-Z]?\d+)?", covers):
        m = re.match(r"([A-Z])(\d+)-(?:[A-Z])?(\d+)$", tok)
        out += [f"{m.group(1)}{i}" for i in range(int(m.group(2)), int(m.group(3)) + 1)] if m else [tok]
    return out


def main() -> None:
    from mercato.plans.registry import all_queries

    queries = all_queries()
    print("# Registered queries\n")
    print("Every query reads the driver tables (or data Spark derives from them) and has a DuckDB oracle")
    print("unless marked rows-only. Generated by `python -m mercato.plans.index`.\n")
    print("| query | module | covers (SURVEY §2 IDs) | check |")
    print("|---|---|---|---|")
    by_id: dict[str, list[str]] = {}
    for name, q in sorted(queries.items()):
        module = q.fn.__module__.rsplit(".", 1)[-1]
        check = "DuckDB oracle" if q.oracle else "rows only"
        print(f"| `{name}` | {module} | {q.covers} | {check} |")
        for i in expand(q.covers):
            by_id.setdefault(i, []).append(name)
    print("\n## By operator ID\n")
    print("| ID | queries |")
    print("|---|---|")
    for i in sorted(by_id, key=lambda x: (x[0], int(x[1:]))):
        print(f"| {i} | " + ", ".join(f"`{n}`" for n in sorted(by_id[i])) + " |")


if __name__ == "__main__":
    main()
