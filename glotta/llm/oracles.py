"""SQL counterparts of the operators that SQL can express."""

from __future__ import annotations

# Levels that the texts below unroll: up to 3^12 documents of a source, 3^8 sources.
SOURCE_LEVELS = 12
ROOT_LEVELS = 8


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text."""
    steps = "lambda x, i: xor(x >> 1, (x & 1) * 3988292384::ubigint)"
    byte = f"lambda c, b: list_reduce([xor(c, b)] || [0::ubigint, 0, 0, 0, 0, 0, 0, 0], {steps})"
    values = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::ubigint)"
    return f"xor(list_reduce([4294967295::ubigint] || {values}, {byte}), 4294967295::ubigint)"


def _levels(name: str, nodes: str, count: int) -> list[str]:
    """``{name}{k}`` (tree, rank, size, digest): the nodes of level k; a tree of one node stays as it is."""
    out = [f"{name}0 as (select tree, rank, count(*) over (partition by tree) as size, digest from {nodes})"]
    for k in range(1, count + 1):
        out.append(f"{name}{k} as (select tree, rank // 3 as rank, (size + 2) // 3 as size, case when size = 1 "
                   f"then min(digest) else sha256(string_agg(digest, '' order by rank)) end as digest "
                   f"from {name}{k - 1} group by tree, rank // 3, size)")
    return out


def _climb(name: str, levels: str, start: str, count: int) -> list[str]:
    """``{name}{k}``: each leaf's place on level k, the siblings below it and the digest folded so far."""
    out = [f"{name}0 as ({start})"]
    for k in range(count):
        runs = f"(select tree, rank // 3 as run, size, list(digest order by rank) as run_digests from {levels}{k} group by all)"
        out.append(
            f"{name}{k + 1} as (select doc_id, leaf, up, p.tree, p.rank // 3 as rank, "
            "proof || array_to_string(list_filter(run_digests, lambda d, i: i <> p.rank % 3 + 1), '') as proof, "
            "case when size = 1 then node else sha256(array_to_string(list_transform(run_digests, "
            "lambda d, i: case when i = p.rank % 3 + 1 then node else d end), '')) end as node "
            f"from {name}{k} p join {runs} r on r.tree = p.tree and r.run = p.rank // 3)")
    return out


def merkle_manifest() -> str:
    def field(column: str) -> str:
        return f"coalesce(strlen(({column})::varchar) || ':' || ({column})::varchar, '-')"

    def hashed(text: str) -> str:
        return "sha256(" + " || ".join(map(field, ["doc_id", "source", "lang", "n_chars", text])) + ")"

    cut = f"case when {crc32('doc_id::varchar')} % 2 = 0 then replace(text, chr(10), '') else text end"
    ctes = [
        f"hashed as (select doc_id, source, {hashed('text')} as leaf, {hashed(cut)} as tampered from documents)",
        "placed as (select *, dense_rank() over (order by source nulls first) - 1 as tree, "
        "row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as rank from hashed)",
        *_levels("a", "(select tree, rank, leaf as digest from placed)", SOURCE_LEVELS),
        f"subroots as (select tree as rank, 0 as tree, digest from a{SOURCE_LEVELS})",
        *_levels("b", "subroots", ROOT_LEVELS),
        *_climb("p", "a", "select doc_id, leaf, tree as up, tree, rank, '' as proof, tampered as node from placed",
                SOURCE_LEVELS),
        *_climb("q", "b", f"select doc_id, leaf, up, 0 as tree, up as rank, proof, node from p{SOURCE_LEVELS}", ROOT_LEVELS),
    ]
    return (f"with {', '.join(ctes)} select doc_id, leaf, s.digest as subroot, r.digest as root, "
            "sha256(proof) as proof_sha256, node as folded_root, node = r.digest as verified "
            f"from q{ROOT_LEVELS} q join subroots s on s.rank = q.up join b{ROOT_LEVELS} r on true")


def prefix_trie() -> str:
    ctes = [
        "raw as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations "
        "where conv_id is not null)",
        "told as (select conv_id, turn, sha256(strlen(role) || ':' || role || text)[1:32] as id, "
        "len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as words from raw)",
        "turns as (select conv_id, id, words, row_number() over (partition by conv_id order by turn nulls first, id, words) "
        "as pos, count(*) over (partition by conv_id) as n from told)",
        f"convs as (select distinct conv_id, conv_id - conv_id % 20 as host, {crc32('conv_id::varchar')} % 4 as h from turns)",
        "sized as (select c.*, least(h, coalesce(t.n, 0)) as begun from convs c left join turns t "
        "on t.conv_id = c.host and t.pos = 1)",
        "rebuilt as (select c.conv_id, t.pos as depth, t.id, t.words from sized c join turns t on t.conv_id = c.host "
        "and t.pos <= c.h union all select c.conv_id, t.pos - c.h + c.begun, t.id, t.words from sized c join turns t "
        "on t.conv_id = c.conv_id and t.pos > c.h)",
        "paths as (select c.conv_id, coalesce(list(r.id order by r.depth) filter (r.id is not null), []) as ids, "
        "list(r.words order by r.depth) filter (r.id is not null) as words from convs c left join rebuilt r "
        "on r.conv_id = c.conv_id group by c.conv_id)",
        "members as (select conv_id, depth, array_to_string(ids[:depth], '') as node, "
        "array_to_string(ids[:depth - 1], '') as above, coalesce(words[depth], 0) as words, depth = len(ids) as ends "
        "from (select *, unnest(range(len(ids) + 1)) as depth from paths))",
        "nodes as (select node, depth, any_value(above) as above, any_value(words) as words, min(conv_id) as conv_id, "
        "count(*) as n_convs, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) "
        "as ends_sha256 from members group by node, depth)",
        "children as (select above as node, depth - 1 as depth, count(*) as n_children from nodes where depth > 0 group by all)",
        "full_nodes as (select n.*, coalesce(c.n_children, 0) as n_children from nodes n left join children c "
        "on c.node = n.node and c.depth = n.depth)",
        "sums as (select m.node, m.depth, count(*) filter (u.n_children = 0) as n_leaves, "
        "sum((u.n_convs - 1) * u.words) as saved_tokens from full_nodes u join members m on m.conv_id = u.conv_id "
        "and m.depth <= u.depth group by all)",
    ]
    return (f"with {', '.join(ctes)} select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, "
            "s.n_leaves, s.saved_tokens::bigint as saved_tokens, n.ends_sha256 from full_nodes n "
            "join sums s on s.node = n.node and s.depth = n.depth "
            "left join nodes p on p.node = n.above and p.depth = n.depth - 1")


ORACLE_SQL = {
    "op11_splitter_skeleton_trie": prefix_trie(),
    "op12_merkle_manifest": merkle_manifest(),
}
