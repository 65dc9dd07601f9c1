"""The OWL Horst closure as SQL text: every rule applied to everything, a fixed number of rounds over."""

from __future__ import annotations

from kglake.functions import vocab as V
from kglake.operators import horst

_KIND = "case when starts_with({0}, '_:') then 'bnode' else 'iri' end"
_NONE = "cast(null as varchar)"


def _resource(s: str, p: str, o: str) -> str:
    return f"{s} as s, {_KIND.format(s)} as s_kind, {p} as p, {o} as o, {_KIND.format(o)} as o_kind, {_NONE} as o_datatype, {_NONE} as o_lang"


def _list(iris: list[str]) -> str:
    return ", ".join(f"'{x}'" for x in iris)


def _normal(facts: str, name: str) -> str:
    """Everything over the least of all that equals it, with one link for each node replaced."""
    return f"""
{name}_e as materialized (select s as a, o as b from {facts} where p = '{V.OWL_SAME_AS}' union
    select o, s from {facts} where p = '{V.OWL_SAME_AS}'),
{name}_c(node, other) as (select a, b from {name}_e union select c.node, e.b from {name}_c c join {name}_e e on e.a = c.other),
{name}_r as materialized (select node, min(other) as rep from {name}_c group by node having min(other) < node),
{name} as materialized (select distinct coalesce(x.rep, s) as s, {_KIND.format('coalesce(x.rep, s)')} as s_kind, p,
    coalesce(y.rep, o) as o, case when o_kind = 'literal' then o_kind else {_KIND.format('coalesce(y.rep, o)')} end as o_kind,
    o_datatype, o_lang from {facts} left join {name}_r x on x.node = s
    left join {name}_r y on y.node = o and o_kind <> 'literal' where p <> '{V.OWL_SAME_AS}'
    union select {_resource('node', f"'{V.OWL_SAME_AS}'", 'rep')} from {name}_r)"""


def _rules(n: str) -> str:
    """One application of each rule to `n`, and `n` itself."""
    a = f"'{V.RDF_TYPE}'"

    def marked(kind: str) -> str:
        return f"(select s as prop from {n} where p = {a} and o = '{kind}')"

    def restricted(filler: str) -> str:
        return (f"(select x.s as r, x.o as prop, y.o as v, y.o_kind as v_kind, y.o_datatype as v_datatype, y.o_lang as v_lang from {n} x"
                f" join {n} y on x.s = y.s where x.p = '{V.OWL_ON_PROPERTY}' and y.p = '{filler}')")

    parts = [f"select * from {n}"]
    for sub, equal, kinds in ((V.RDFS_SUBCLASS, V.OWL_EQUIVALENT_CLASS, horst.CLASS_KINDS),
                              (V.RDFS_SUBPROPERTY, V.OWL_EQUIVALENT_PROPERTY, horst.PROPERTY_KINDS)):
        q, e = f"'{sub}'", f"'{equal}'"
        parts += [
            f"select {_resource('x.s', q, 'y.o')} from {n} x join {n} y on x.o = y.s where x.p = {q} and y.p = {q}",
            f"select {_resource('s', q, 'o')} from {n} where p = {e}", f"select {_resource('o', q, 's')} from {n} where p = {e}",
            f"select {_resource('o', e, 's')} from {n} where p = {e}",
            f"select {_resource('x.s', e, 'x.o')} from {n} x join {n} y on x.s = y.o and x.o = y.s"
            f" where x.p = {q} and y.p = {q} and x.s <> x.o",
            f"select {_resource('x.o', q, 'x.o')} from {n} x join {n} k on k.s = x.o and k.p = {a} and k.o in ({_list(kinds)})"
            f" where x.p = '{V.OWL_SAME_AS}'",
        ]
    parts += [
        f"select t.s, t.s_kind, h.o as p, t.o, t.o_kind, t.o_datatype, t.o_lang from {n} t join {n} h on h.s = t.p"
        f" where h.p = '{V.RDFS_SUBPROPERTY}' and not starts_with(h.o, '_:')",
        f"select {_resource('t.s', a, 'd.o')} from {n} t join {n} d on d.s = t.p where d.p = '{V.RDFS_DOMAIN}'",
        f"select {_resource('t.o', a, 'd.o')} from {n} t join {n} d on d.s = t.p where d.p = '{V.RDFS_RANGE}' and t.o_kind <> 'literal'",
        f"select {_resource('t.s', a, 'h.o')} from {n} t join {n} h on h.s = t.o where t.p = {a} and h.p = '{V.RDFS_SUBCLASS}'",
        f"select {_resource('t.o', 'i.q', 't.s')} from {n} t join (select s as p, o as q from {n} where p = '{V.OWL_INVERSE_OF}' union"
        f" select o, s from {n} where p = '{V.OWL_INVERSE_OF}' union select prop, prop from {marked(V.OWL_SYMMETRIC)}) i on i.p = t.p"
        " where t.o_kind <> 'literal'",
        f"select {_resource('x.s', 'x.p', 'y.o')} from {n} x join {marked(V.OWL_TRANSITIVE)} m on m.prop = x.p"
        f" join {n} y on y.p = x.p and y.s = x.o where x.o_kind <> 'literal' and y.o_kind <> 'literal'",
    ]
    same = f"'{V.OWL_SAME_AS}'"
    for kind, key, value in ((V.OWL_FUNCTIONAL, "s", "o"), (V.OWL_INVERSE_FUNCTIONAL, "o", "s")):
        grouped = (f"(select {value} as v, min({value}) over (partition by p, {key}) as least from {n} join {marked(kind)} on prop = p"
                   " where o_kind <> 'literal')")
        parts.append(f"select {_resource('v', same, 'least')} from {grouped} where v <> least")
    parts += [
        f"select {_resource('t.s', a, 'r.r')} from {n} t join {restricted(V.OWL_HAS_VALUE)} r on t.p = r.prop and t.o = r.v"
        " and t.o_kind = r.v_kind and t.o_datatype is not distinct from r.v_datatype and t.o_lang is not distinct from r.v_lang",
        f"select t.s, t.s_kind, r.prop, r.v, r.v_kind, r.v_datatype, r.v_lang from {n} t join {restricted(V.OWL_HAS_VALUE)} r"
        f" on t.o = r.r where t.p = {a}",
        f"select {_resource('t.s', a, 'r.r')} from {n} t join {restricted(V.OWL_SOME_VALUES)} r on t.p = r.prop"
        f" join {n} k on k.s = t.o and k.o = r.v where k.p = {a} and t.o_kind <> 'literal'",
        f"select {_resource('t.o', a, 'r.v')} from {n} t join {restricted(V.OWL_ALL_VALUES)} r on t.p = r.prop"
        f" join {n} k on k.s = t.s and k.o = r.r where k.p = {a} and t.o_kind <> 'literal'",
    ]
    return " union ".join(parts)


def closure(rounds: int) -> str:
    """CTEs `n1` to `n<rounds>`, each what the rules add to the one before, over `triples`.

    With one round more than the closure needs, the last one adds nothing, and a round too few would show.
    """
    out = ["r0 as materialized (select distinct * from triples)"]
    for k in range(1, rounds + 1):
        out += [_normal(f"r{k - 1}", f"n{k}"), f"r{k} as materialized ({_rules(f'n{k}')})"]
    return ", " + ", ".join(out) + f", closed as (select * from r{rounds})"
