"""Write OPERATORS.md: SURVEY ids -> registered queries, oracle, description."""

import re

from firn.plans import registry


def main():
    registry.load_all()
    rows = []
    for name, fn in registry.QUERIES.items():
        m = re.match(r"([a-z]+)(\d+)_", name)
        sid = f"{m.group(1).upper()}{m.group(2)}" if m else "chain"
        doc = " ".join((fn.__doc__ or "").split())
        rows.append((sid, name, "SQL" if name in registry.ORACLES else "rows", doc))
    order = {"IO": 0, "P": 1, "J": 2, "A": 3, "W": 4, "SO": 5, "U": 6, "G": 7, "M": 8, "T": 9, "chain": 10}

    def key(r):
        m = re.match(r"([A-Z]+)(\d+)", r[0])
        return (order[m.group(1)], int(m.group(2)), r[1]) if m else (10, 0, r[1])
    rows.sort(key=key)
    ids = sorted({r[0] for r in rows if r[0] != "chain"}, key=lambda s: key((s, "", "", "")))
    out = ["# Operator coverage", "",
           f"{len(ids)} SURVEY §2 ids, {len(rows)} registered queries, "
           f"{sum(r[2] == 'SQL' for r in rows)} with a DuckDB oracle. Generated by `tools_operators.py`.", "",
           "| id | query | check | what it computes |", "|---|---|---|---|"]
    out += [f"| {a} | `{b}` | {c} | {d} |" for a, b, c, d in rows]
    open("OPERATORS.md", "w").write("\n".join(out) + "\n")


if __name__ == "__main__":
    main()
