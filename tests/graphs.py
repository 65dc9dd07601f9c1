"""Small hand-checked graphs."""

RDFS = "http://www.w3.org/2000/01/rdf-schema#"
SUB = f"<{RDFS}subClassOf>"
SUBP = f"<{RDFS}subPropertyOf>"
EX = "http://ex.org/t/"


def line(s, p, o):
    return f"<{EX}{s}> {p} <{EX}{o}> ."


def taxonomy(cyclic: bool) -> list[str]:
    """Node n10 under n1, a chain and a branch below it; n10 and n200 form the cycle."""
    rows = [
        line("n10", SUB, "n1"), line("n100", SUB, "n10"), line("n1000", SUB, "n100"),
        line("n10000", SUB, "n1000"), line("n200", SUB, "n10"), line("n2000", SUB, "n200"),
        line("n30", SUBP, "n10"), line("n300", SUBP, "n30"), line("n400", SUBP, "n30"),
        f'<{EX}n9> <{RDFS}label> "Leaf nine" .',
    ]
    return rows + [line("n10", SUB, "n200")] if cyclic else rows


def write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)
