"""The queries' meaning in DuckDB's SQL, written on its own."""

from __future__ import annotations

#: Texts of the driver's tables have no other white space than these patterns know.
HASH = r"sha256(regexp_replace(regexp_replace(trim(text, E' \t\n\r\f\v'), '\r\n|\r', E'\n', 'g'), '[ \t]+\n', E'\n', 'g'))"
HASHED = f"hashed as (select doc_id, lang, source, text, {HASH} as content_hash from documents)"
SPLIT = f"""{HASHED}, keys as (select distinct content_hash from hashed), ranked as (
  select content_hash, row_number() over (order by sha256(concat('42', content_hash)), content_hash) as r, count(*) over () as n from keys
), assigned as (
  select content_hash, case when r <= floor(n * 0.05::double) then 'test' when r <= floor(n * 0.05::double) + floor(n * 0.05::double) then 'validation' else 'train' end as split from ranked
), split_rows as (select h.*, a.split from hashed h join assigned a using (content_hash))"""
LEGACY = f"""{HASHED}, ranked as (
  select *, row_number() over (order by sha256(concat('42', doc_id::varchar)), doc_id) as r, count(*) over () as n from hashed
), legacy as (
  select doc_id, content_hash, case when r <= floor(n * 0.05::double) then 'test' when r <= 2 * floor(n * 0.05::double) then 'validation' else 'train' end as split from ranked
)"""
REASONS = """reasons as (
  select h.doc_id, h.source, case when l.quality is null then 'missing_hash' when l.quality = 0 then 'missing_symbols' end as reason
  from hashed h left join labels l using (doc_id))"""
FIRST = """firsts as (
  select conv_id, arg_min(text, turn) filter (role = 'user') as "user", arg_min(text, turn) filter (role = 'assistant') as assistant, count(*) as turns from conversations group by 1)"""
CHECKED = f"""{FIRST}, checked as (
  select *, "user" is null or assistant is null or trim("user", E' \\t\\n\\r\\f\\v') = '' or trim(assistant, E' \\t\\n\\r\\f\\v') = '' as bad from firsts)"""
TAGS = """tagged as (
  select doc_id, lower(text) as t,
    contains(lower(text), ' the ') or contains(lower(text), ' and ') as en, contains(lower(text), ' der ') or contains(lower(text), ' und ') as de,
    contains(lower(text), ' les ') or contains(lower(text), ' une ') as fr, contains(lower(text), 'license') as li, contains(lower(text), '%%%') as ma
  from documents)"""
MEASURED = """measured as (
  select doc_id, text, len(text) - len(replace(text, chr(10), '')) + 1 as lines, n_chars % 7 as objects, n_chars % 5 as moves, n_chars % 23 as calls from documents)"""

ORACLE_SQL = {
    "stable_hash_docs": f"with {HASHED} select doc_id, content_hash from hashed",
    "dedup_keep_first": f"with {HASHED} select min(doc_id) as doc_id, lang, content_hash from hashed group by lang, content_hash",
    "dedup_removed_count": f"with {HASHED} select count(*) as rows_in, count(*) - count(distinct (content_hash, lang)) as removed from hashed",
    "split_by_hash": f"with {SPLIT} select doc_id, content_hash, split from split_rows",
    "split_sizes": f"with {SPLIT} select split, count(*) as rows, count(distinct content_hash) as groups from split_rows group by 1",
    "legacy_split": f"with {LEGACY} select doc_id, split from legacy",
    "legacy_split_leakage": f"with {LEGACY} select content_hash, count(distinct split) as n, string_agg(distinct split, ',' order by split) as places from legacy group by 1 having count(distinct split) > 1",
    "split_integrity": f"with {SPLIT} select split, count(*) as examples, count(distinct content_hash) as unique_hashes, (select count(*) from (select content_hash from split_rows group by 1 having count(distinct split) > 1)) as leakage_count from split_rows group by 1",
    "cross_source_leakage": f"with {HASHED} select content_hash, count(distinct source) as sources, min(source) as first_source from hashed group by 1 having count(distinct source) > 1",
    "curation_split_report": f"with {SPLIT}, kept as (select min(doc_id) as doc_id, content_hash, lang, min(split) as split from split_rows group by content_hash, lang) select split, count(*) as examples, count(distinct content_hash) as unique_hashes from kept group by 1",
    "model_ready_reasons": f"with {HASHED}, {REASONS} select source, coalesce(reason, 'kept') as reason, count(*) as n from reasons group by 1, 2",
    "model_ready_union": f"""with {SPLIT}, {REASONS}, sources as (select source, row_number() over (order by source nulls last) - 1 as k, count(*) over () as n from (select distinct source from documents))
        select s.doc_id, s.split, s.source as model_ready_source, (case s.split when 'train' then 0 when 'validation' then 1 else 2 end * u.n + u.k)::int as part
        from split_rows s join reasons r using (doc_id) join sources u on u.source is not distinct from s.source where r.reason is null""",
    "train_small": f"with {SPLIT}, {REASONS} select s.doc_id, s.content_hash from split_rows s join reasons r using (doc_id) where r.reason is null and s.split = 'train' order by s.doc_id limit 512",
    "sample_heads": f"with {SPLIT} (select doc_id, split from split_rows where split = 'train' order by doc_id limit 128) union all (select doc_id, split from split_rows where split = 'validation' order by doc_id limit 32)",
    "chat_examples": f"""with {FIRST} select conv_id, 'user' as role, "user" as content from firsts union all select conv_id, 'assistant', assistant from firsts""",
    "instruction_rows": f"""with {FIRST} select conv_id, "user" as instruction, '' as input, assistant as output from firsts""",
    "training_texts": f"""with {FIRST} select conv_id, '### Instruction:' || chr(10) || "user" || chr(10) || chr(10) || '### Response:' || chr(10) || assistant as text from firsts""",
    "bad_rows": f"with {CHECKED} select conv_id, bad from checked",
    "training_profile": f"""with {CHECKED} select count(*) as rows_checked, count(*) filter (bad) as bad_rows, coalesce(max(len(assistant)) filter (not bad), 0)::bigint as max_code_chars,
        nullif(count(*) filter (not bad and turns > 5), 0) as long_rows, nullif(count(*) filter (not bad and not turns > 5), 0) as unknown_rows,
        nullif(count(*) filter (not bad and conv_id % 2 = 0), 0) as even_rows, nullif(count(*) filter (not bad and conv_id % 2 = 1), 0) as odd_rows,
        coalesce(round(avg(len("user")) filter (not bad), 2), 0) as avg_prompt_chars, coalesce(round(avg(len(assistant)) filter (not bad), 2), 0) as avg_code_chars from checked""",
    "identifiers": r"""with names as (select distinct p_name as name from part union all select c_name from customer union all
        select * from (values ('SineWaveScene'), ('HTTPServer'), ('my_scene2D'), ('already words'), ('A'), ('')))
        select name, lower(trim(regexp_replace(regexp_replace(replace(name, '_', ' '), '([a-z0-9])([A-Z])', '\1 \2', 'g'), '\s+', ' ', 'g'))) as words from names""",
    "brand_labels": """with s as (select distinct p_brand, p_size from part), r as (select *, row_number() over (partition by p_brand order by p_size desc) as k from s),
        p as (select p_brand, max(p_size) filter (k = 1) as a, max(p_size) filter (k = 2) as b, max(p_size) filter (k = 3) as c from r group by 1)
        select p_brand, case when b is null then a::varchar when c is null then a || ' and ' || b else a || ', ' || b || ', and ' || c end as label from p""",
    "keyword_tags": f"with {TAGS} select doc_id, concat_ws(',', case when en then 'english' end, case when de then 'german' end, case when fr then 'french' end, case when li then 'licensed' end, case when ma then 'marked' end) as tags from tagged",
    "category_counts": f"with {TAGS} select case when li then 'legal' when ma then 'junk' when de then 'de' when fr then 'fr' when en then 'en' else 'general' end as category, count(*) as n from tagged group by 1",
    "difficulty_histogram": f"""with {MEASURED}, p as (select lines * 0.04::double + objects * 0.8::double + moves * 1.0::double + calls * 0.12::double as points from measured)
        select case when points < 6.0::double then 'beginner' when points < 16.0::double then 'intermediate' else 'advanced' end as difficulty, count(*) as n from p group by 1""",
    "quality_scores": f"""with {MEASURED} select doc_id, round(least(1.0::double, 0.25::double + case when calls > 3 then 0.25::double else 0 end + case when objects > 0 then 0.15::double else 0 end
        + case when moves > 0 then 0.15::double else 0 end + case when lines >= 5 then 0.1::double else 0 end + case when contains(text, 'license') or contains(text, 'License') then 0.1::double else 0 end), 3) as quality_score from measured""",
    "ordered_unique_roles": "with f as (select conv_id, role, min(turn) as t from conversations where role <> '' group by 1, 2) select conv_id, string_agg(role, ',' order by t, role) as roles from f group by 1",
    "dependency_closure": """with recursive edges(scope, src, dst) as (values ('m','a','b'), ('m','b','c'), ('m','c','a'), ('m','a','d'), ('m','d','d'), ('m','x','y'), ('n','a','z')),
        reach(scope, name, depth) as (select * from (values ('m','a',0), ('n','a',0)) union all select r.scope, e.dst, r.depth + 1 from reach r join edges e on e.scope = r.scope and e.src = r.name where r.depth < 8)
        select scope, name, min(depth)::bigint as depth from reach group by 1, 2""",
    "missing_symbols": "select 'm' as scope, name from (values ('a'), ('b'), ('print'), ('q'), ('_hidden')) u(name) where name not in ('a', 'print') and not starts_with(name, '_')",
    "scene_extract": """select * from (values
        ('lib/waves.py', 'SineWaveScene', 5, 10, 'Axes,plot,play,wait,Create,sin', '', '', '16610ad3db0b585e92b7a7e36471995810ceeb909a94ef8e6904fbbcd9c2134e'),
        ('lib/waves.py', 'RotatingSquareScene', 13, 16, 'Square,play,Rotate', '', '', '66de7d674d3674254659dc42fecb24175f8a91233a28b87c5bf6a9216fe40906'),
        ('lib/helpers.py', 'HelperScene', 7, 8, '', '', '', sha256('import manim as m' || chr(10) || chr(10) || 'class HelperScene(m.Scene):' || chr(10) || '    pass')),
        ('lib/helpers.py', 'MainScene', 10, 12, 'add,make_label', 'HelperScene,make_label,SCALE', 'unknown_thing', sha256(concat_ws(chr(10), 'import manim as m', '', 'SCALE = 2', '', 'def make_label(t):',
           '    return m.Text(t).scale(SCALE)', '', 'class HelperScene(m.Scene):', '    pass', '', 'class MainScene(HelperScene):', '    def construct(self):', '        self.add(make_label("x"), unknown_thing)')))
        ) t(source_path, scene_name, line_start, line_end, calls, needs, missing, content_hash)""",
    "scene_metadata": """select * from (values
        ('SineWaveScene', 'graphs,physics,animation', 'graphs', 'beginner', 1.0::double, 'valid'), ('RotatingSquareScene', 'geometry,animation', 'geometry', 'beginner', 0.9::double, 'valid'),
        ('HelperScene', '', 'general', 'beginner', 0.35::double, 'failed'), ('MainScene', '', 'general', 'beginner', 0.6::double, 'valid')) t(scene_name, tags, category, difficulty, quality_score, status)""",
    "scene_prompts": """select * from (values ('SineWaveScene', 'Visualize a graph with axes using Create'), ('RotatingSquareScene', 'Create a square scene using Rotate'),
        ('HelperScene', 'Create a Manim animation showing illustrates helper scene'), ('MainScene', 'Create a Manim animation showing illustrates main scene')) t(scene_name, prompt)""",
    "parse_report": "select * from (values ('lib/waves.py', false, 2::bigint, 2::bigint), ('lib/helpers.py', false, 2::bigint, 1::bigint), ('lib/broken.py', true, 0::bigint, 0::bigint)) t(path, failed, units, imports)",
    "extract_statistics": "select 3::bigint as scanned_files, 2::bigint as parsed_files, 1::bigint as failed_files, 4::bigint as discovered_scenes, 3::bigint as valid_scenes, 3::bigint as exported_examples, 0::bigint as duplicates_removed, 1::bigint as graphs",
    "jsonl_roundtrip": "select doc_id, text, true as same from documents",
    "repo_scan": "select * from (values ('.hid/c.py', 6::bigint), ('_2018/b.py', 6::bigint), ('a.py', 6::bigint), ('sub/__init__.py', 6::bigint)) t(file, chars)",
    "cleanup_safety": """select * from (values ('/w/src/core', true, 'protected source/configuration path'), ('/x/out', true, 'outside workspace: /x/out'), ('/w/out', false, 'missing'), ('/w', true, 'empty target'),
        ('/w/out', true, null), ('/w/src/__pycache__', true, null)) t(path, there, reason)""",
    "jsonl_lines": f"""with {FIRST} select conv_id, assistant as text, null::varchar as category from firsts where "user" is not null and assistant is not null""",
    "line_numbers": r"select row_number() over (order by doc_id) as line_no, length(regexp_replace(text, '[\r\n]+', ' ', 'g')) as chars from documents",
    "prompt_variants": """with templates(i, a, b) as (values (0, 'Create a Manim scene showing ', ''), (1, 'Write Manim code for ', ''), (2, 'Animate ', ''), (3, 'Build a concise Manim animation showing ', '')),
        drawn as (select p_partkey, a || p_name || b as prompt, row_number() over (partition by p_partkey order by sha256('42|' || p_partkey::varchar || '|' || a || '{}' || b), i) as variant from part, templates),
        firsts as (select p_partkey, case when p_size < 10 then 'Visualize ' when p_size < 20 then 'Create ' when p_size < 30 then 'Show ' else 'Create a Manim animation showing ' end || p_name as prompt from part)
        select p_partkey, 0::bigint as variant, prompt from firsts union all select p_partkey, variant, prompt from drawn where variant <= 2""",
    "module_units": """select * from (values
        ('alias.py', 'Alias', true, 3, 5, 'Scene', 'add,array', '', 'Scene,p'), ('branch.py', 'Seen', true, 5, 7, 'Scene', 'add', '', 'K,Scene'), ('decorated.py', 'Deco', true, 3, 5, 'Scene', 'wait', '', ''),
        ('future.py', 'Future', true, 3, 5, 'MyScene', 'play,Create', '', ''), ('late.py', 'Late', false, 1, 3, 'Scene', '', '', 'Scene'),
        ('mutual.py', 'Outer', true, 2, 6, 'manim.Scene', 'add,helper', 'helper,other,STEP', 'Scene'), ('unpack.py', 'Unpack', true, 4, 6, 'manim.ThreeDScene', 'add', 'a,b,c', '')
        ) t(source_path, scene_name, has_construct, line_start, line_end, bases, calls, needs, missing)""",
    "module_imports": """select * from (values ('alias.py', 'numpy', 'numpy', 'np'), ('alias.py', 'math', 'pi,tau', null), ('branch.py', 'manim', 'manim', null), ('decorated.py', 'manim', '*', null),
        ('future.py', '__future__', 'annotations', null), ('future.py', 'manimlib', '*', null), ('mutual.py', 'manim', 'manim', null), ('unpack.py', 'manim', 'manim', null)) t(path, module, names, alias)""",
    "module_validation": """select * from (values
        ('Alias', 'failed', 'Unresolved dependency symbols: Scene, p', ''), ('Seen', 'failed', 'Unresolved dependency symbols: K, Scene', ''), ('Deco', 'valid', '', ''),
        ('Future', 'valid', '', 'No explicit Manim import found.'), ('Late', 'failed', 'Scene class has no construct() method. | Unresolved dependency symbols: Scene', ''),
        ('Outer', 'failed', 'Unresolved dependency symbols: Scene', ''), ('Unpack', 'valid', '', '')) t(scene_name, status, errors, warnings)""",
    "scene_chat_rows": """select *, 'user,assistant' as roles, true as hash_of_code, 'sample' as source_repo from (values
        ('SineWaveScene', 'Visualize a graph with axes using Create', 6::bigint, 1::bigint, 1::bigint, 6::bigint, true, 'valid', 'Axes', 'Create', '', '', ''),
        ('RotatingSquareScene', 'Create a square scene using Rotate', 4, 1, 1, 3, true, 'valid', 'Square', 'Rotate', '', '', ''),
        ('HelperScene', 'Create a Manim animation showing illustrates helper scene', 2, 0, 0, 0, false, 'failed', '', '', '', '', ''),
        ('MainScene', 'Create a Manim animation showing illustrates main scene', 3, 0, 0, 2, true, 'valid', '', '', 'HelperScene,make_label,SCALE', 'unknown_thing', 'HelperScene>,make_label>SCALE,SCALE>')
        ) t(scene_name, prompt, line_count, object_count, animation_count, call_count, has_construct, status, objects, animations, included, missing, tree)""",
    "model_ready_chain": "select * from (values ('one', 2::bigint, 11::bigint, 4::bigint, 4::bigint), ('two', 5, 11, 4, 4)) t(source, rows, total, missing_symbols, small)",
    "source_decoding": """select * from (values ('latin.py', 's = ' || chr(39) || 'é' || chr(39) || chr(10)), ('crlf.py', 'a' || chr(10) || 'b' || chr(10) || 'c' || chr(10)), ('bom.py', chr(65279) || 'x' || chr(10)), ('utf.py', 'é漢' || chr(10))) t(file, source)""",
    "training_head": f"""with {FIRST} select row_number() over (order by conv_id) as line_no, '### Instruction:' || chr(10) || "user" || chr(10) || chr(10) || '### Response:' || chr(10) || assistant as text
        from firsts order by conv_id limit 128""",
}
