"""The registered queries in SQL that DuckDB runs on the same tables: plain joins on the predicates, no bins."""

from __future__ import annotations

from ..functions.expressions import DIRECTIONS
from .fixtures import ctes

SAMPLES = [f"S{i}" for i in range(6)]
XY = "donor_chrom, donor_bp, donor_strand, acceptor_chrom, acceptor_bp, acceptor_strand"

NAMED = "donor_chrom, donor_bp as donor_breakpoint, donor_strand, acceptor_chrom, acceptor_bp as acceptor_breakpoint, acceptor_strand"

GENES = """genes as (select gene_id, min(chrom) as chrom, min(start0) as start0, max(end0) as end0, min(strand) as strand from fx_exons group by gene_id)"""

EVENTS = f"""ev as (select sample, {XY}, arg_min(junction_type, line_no) as junction_type, arg_min(repeat_flag, line_no) as repeat_flag, count(*) as reads from fx_junctions group by sample, {XY}),
bp as (select distinct donor_chrom as chrom, donor_bp as bp from ev union select distinct acceptor_chrom, acceptor_bp from ev)"""


def hits(tol: int = 0) -> str:
    part = lambda name, table, key: f"{name} as (select b.chrom, b.bp, list_sort(list(distinct f.{key})) as ids from bp b join {table} f on f.chrom = b.chrom and f.start0 < b.bp + 1 + {tol} and f.end0 > b.bp - 1 - {tol} group by b.chrom, b.bp)"
    return (
        part("hg", "fx_exons", "gene_id") + ",\n" + part("ht", "fx_te", "te_id") + """,
eh as (select ev.*, coalesce(a.ids, []) as dg, coalesce(b.ids, []) as dt, coalesce(c.ids, []) as ag, coalesce(d.ids, []) as at_
  from ev left join hg a on a.chrom = donor_chrom and a.bp = donor_bp left join ht b on b.chrom = donor_chrom and b.bp = donor_bp
  left join hg c on c.chrom = acceptor_chrom and c.bp = acceptor_bp left join ht d on d.chrom = acceptor_chrom and d.bp = acceptor_bp),
ed as (select *, case when len(dg) > 0 and len(at_) > 0 then 'gene_to_te' when len(dt) > 0 and len(ag) > 0 then 'te_to_gene' when len(dg) > 0 and len(ag) > 0 then 'gene_to_gene'
  when len(dt) > 0 and len(at_) > 0 then 'te_to_te' when len(dg) > 0 then 'gene_to_other' when len(ag) > 0 then 'other_to_gene' when len(dt) > 0 then 'te_to_other' else 'other' end as direction from eh),
ec as (select *, case when direction in ('gene_to_te', 'gene_to_gene', 'gene_to_other') then dg[1] when direction in ('te_to_gene', 'other_to_gene') then ag[1] end as gene_id,
  case direction when 'gene_to_te' then at_[1] when 'te_to_gene' then dt[1] when 'te_to_te' then dt[1] when 'te_to_other' then dt[1] end as te_id,
  case when direction = 'other' then '.' when direction in ('te_to_gene', 'other_to_gene') then acceptor_strand else donor_strand end as side_strand from ed)"""
    )


META = """em as (select ec.*, g.start0 as gene_start, g.end0 as gene_end, coalesce(g.strand, '.') as gene_strand, t.start0 as te_start, t.end0 as te_end, coalesce(t.te_family, '.') as te_family, coalesce(t.te_class, '.') as te_class
  from ec left join genes g using (gene_id) left join (select te_id, min(start0) as start0, min(end0) as end0, min(te_family) as te_family, min(te_class) as te_class from fx_te group by te_id) t using (te_id))"""


INFERRED = """al as (select *, row_number() over (partition by sample, read_id order by chrom, start0, end0, strand) as aln from fx_alignments),
hs as (select a.sample, a.read_id, a.aln, a.strand, min(g.strand) as lo, max(g.strand) as hi from al a join genes g on a.chrom = g.chrom and g.start0 < a.end0 and g.end0 > a.start0 group by all),
inf as (select sample, count(*) as n_reads, (select count(*) from hs where hs.sample = fx_alignments.sample and lo = hi and strand = lo) / count(*)::double as forward,
  (select count(*) from hs where hs.sample = fx_alignments.sample and lo = hi and strand = case lo when '+' then '-' when '-' then '+' else '.' end) / count(*)::double as reverse from fx_alignments group by sample),
called as (select *, case when forward >= 0.6 then 'forward' when reverse >= 0.6 then 'reverse' else 'no' end as call from inf)"""
INFER = "with " + ctes("fx_exons", "fx_alignments") + ", " + GENES + ", " + INFERRED
RESOLVED = "select s.sample, coalesce(case when cast(substr(s.sample, 2) as bigint) % 2 = 0 then case strandedness when 'unstranded' then 'no' else strandedness end end, c.call, 'no') as call from fx_sheet s left join called c on c.sample = s.sample"


def annotated(tol: int = 0, cis: bool = False, canonical: bool = False, own_calls: bool = False) -> str:
    """The annotated events; own_calls: by the library calls of the sheet and the alignments in place of six given ones."""
    views, library = ["fx_exons", "fx_te", "fx_junctions"], "case sample when 'S0' then 'forward' when 'S4' then 'forward' when 'S1' then 'reverse' when 'S5' then 'reverse' else 'no' end"
    if own_calls:
        views, library = [*views, "fx_alignments", "fx_sheet"], "coalesce(found, 'no')"
    events = "(select em.*, k.call as found from em left join calls k on k.sample = em.sample) em" if own_calls else "em"
    calls = f"{INFERRED}, calls as ({RESOLVED}),\n" if own_calls else ""
    trans = " and donor_chrom = acceptor_chrom" if cis else ""
    keep = " where try_cast(junction_type as bigint) between 1 and 6" if canonical else ""
    return (
        "with " + ctes(*views) + ",\n" + GENES + ",\n" + calls + EVENTS + ",\n" + hits(tol) + ",\n" + META + f""",
an as (select concat_ws(':', donor_chrom, donor_bp, donor_strand, acceptor_chrom, acceptor_bp, acceptor_strand, direction) as event_id, sample, {NAMED}, junction_type,
  case when try_cast(junction_type as bigint) between 1 and 6 then 'yes' else 'no' end as canonical, repeat_flag, reads,
  'gene:' || case when len(dg) > 0 then array_to_string(dg, ',') else '.' end || '|te:' || case when len(dt) > 0 then array_to_string(dt, ',') else '.' end as donor_hits,
  'gene:' || case when len(ag) > 0 then array_to_string(ag, ',') else '.' end || '|te:' || case when len(at_) > 0 then array_to_string(at_, ',') else '.' end as acceptor_hits,
  direction, coalesce(gene_id, '.') as gene_id, gene_strand, coalesce(te_id, '.') as te_id, te_family, te_class,
  case when direction not in ('gene_to_te', 'te_to_gene') or gene_start is null or te_start is null or not (true{trans}) then '.'
    when gene_strand = '+' then case when te_end < gene_start then 'te_initiated' when te_start > gene_end then 'te_terminated' else 'te_exonized' end
    when gene_strand = '-' then case when te_start > gene_end then 'te_initiated' when te_end < gene_start then 'te_terminated' else 'te_exonized' end else '.' end as chimera_type,
  case when direction in ('gene_to_te', 'te_to_gene') and exists (select 1 from genes x where x.chrom = case when direction = 'gene_to_te' then acceptor_chrom else donor_chrom end
    and x.start0 < em.te_end and x.end0 > em.te_start and x.gene_id <> em.gene_id and x.strand = case em.gene_strand when '+' then '-' when '-' then '+' else '.' end) then 'yes' else '.' end as antisense_flag,
  {library} as library_strand, case library_strand when 'forward' then side_strand when 'reverse' then case side_strand when '+' then '-' when '-' then '+' else '.' end else 'NA' end as transcript_strand from {events}{keep}),
af as (select *, case when transcript_strand = 'NA' or gene_strand = '.' then 'NA' when transcript_strand = gene_strand then 'yes' else 'no' end as gene_strand_match from an)
"""
    )


CLASSIFIED = "with " + ctes("fx_exons", "fx_te", "fx_junctions") + ",\n" + GENES + ",\n" + EVENTS + ",\n" + hits() + "\n"
WITH_META = CLASSIFIED.rstrip() + ",\n" + META + "\n"
AF = annotated()
CNT = "with " + ctes("fx_cnt")
LOCI = CNT + ", c as (select sample, case when starts_with(feature, 'SF') then 'T1:' || feature else feature end as feature, n from fx_cnt)"


def kind(least: int, table: str) -> str:
    """Keys split by the rule of a level."""
    te = f"(len(p) >= {least} and len(list_filter(p, lambda x: x = '')) = 0)"
    return f""", k as (select *, case when {te} then 'TE' else 'gene' end as kind, case when {te} then p[-2] end as te_family,
  case when {te} then case when len(p) >= 3 and p[-1] in ('LINE', 'SINE', 'LTR', 'DNA', 'RC') then p[-1] else 'unknown' end end as te_class from (select *, string_split(feature, ':') as p from {table}))"""


def pct(n: str, total: str) -> str:
    return f"case when {total} > 0 then round(100.0 * {n} / {total}, 1) else 0.0 end"


def long_counts(where: str, column: str, values: tuple[str, ...], n: str = "count(*)") -> str:
    """A row for each sample and value, zeros included."""
    listed = ", ".join(f"('{v}')" for v in values)
    return f"s as (select distinct sample from {where}), v(v) as (values {listed}), l as (select s.sample, v.v as {column}, (select coalesce({n}, 0) from {where} x where x.sample = s.sample and x.{column} = v.v) as n from s cross join v)"


GRID = CNT + """, c as (select * from fx_cnt), g as (select f.feature, s.sample, coalesce(c.n, 0) as n
  from (select distinct feature from c) f cross join (select distinct sample from c) s left join c on c.feature = f.feature and c.sample = s.sample),
lg as (select feature, sample, log2(n + 1.0) as x from g)"""
FACTORS = GRID + """, r as (select sample, ln(n) - avg(ln(n)) over (partition by feature) as r from (select *, min(n) over (partition by feature) as least from g) where least > 0),
sf as (select sample, exp(quantile_cont(r, 0.5)) as size_factor from r group by sample),
nq as (select g.feature, g.sample, g.n, g.n / size_factor as q, size_factor from g join sf using (sample)),
dp as (select feature, mu, case when mu > 0 then greatest(0.0, (v - xi * mu) / (mu * mu)) else 0.0 end as alpha from (select feature, avg(q) as mu, var_samp(q) as v, avg(1 / size_factor) as xi from nq group by feature))"""
CONTRAST = """ct as (select c2.condition || '_vs_' || c1.condition as contrast, s.sample, case when s.condition = c2.condition then 'treatment' else 'control' end as role
  from (select distinct condition from fx_sheet) c1 join (select distinct condition from fx_sheet) c2 on c1.condition < c2.condition join fx_sheet s on s.condition in (c1.condition, c2.condition)
  where not exists (select 1 from fx_sheet where condition is null))"""
EFFECTS = FACTORS + ", " + ctes("fx_sheet") + ", " + CONTRAST + """, side as (select contrast, feature, sum(n) as total, avg(q) as base_mean, avg(q) filter (role = 'treatment') as t, avg(q) filter (role = 'control') as c,
  count(*) filter (role = 'treatment') as nt, count(*) filter (role = 'control') as nc from nq join ct using (sample) group by contrast, feature),
ef as (select contrast, feature, base_mean, log2((t + 0.5) / (c + 0.5)) as log2fc, log2((t + 0.5) / (c + 0.5)) / (sqrt((1 / greatest(t, 0.5) + alpha) / nt + (1 / greatest(c, 0.5) + alpha) / nc) / ln(2)) as z
  from side join dp using (feature) where total >= 1 and nt > 0 and nc > 0)"""


def assignment(key: str = "te_id", te: str = "fx_te", strand: str = "true", own: str = "fx_alignments") -> str:
    """The hits of fx_alignments, or of a table like it; a strand rule may look at the alignment a and the feature f."""
    return f"""loc as (select *, concat_ws(':', te_id, te_family, te_family, te_class) as locus from fx_te),
an as (select *, row_number() over (partition by sample, read_id order by chrom, start0, end0, strand) as aln, count(*) over (partition by sample, read_id) as n from {own}),
hg as (select a.sample, a.read_id, a.aln, list_sort(list(distinct f.gene_id)) as ids from an a join fx_exons f on a.chrom = f.chrom and f.start0 < a.end0 and f.end0 > a.start0 and {strand} group by all),
ht as (select a.sample, a.read_id, a.aln, list_sort(list(distinct f.{key})) as ids from an a join {te} f on a.chrom = f.chrom and f.start0 < a.end0 and f.end0 > a.start0 and {strand} group by all),
h as (select an.sample, an.read_id, an.aln, an.n, case when len(g.ids) = 1 then g.ids when len(g.ids) > 1 then ['__ambiguous'] else t.ids end as features from an left join hg g using (sample, read_id, aln) left join ht t using (sample, read_id, aln)),
hits as (select * from h where features is not null)"""


def assigned(key: str = "te_id", te: str = "fx_te", strand: str = "true") -> str:
    return "with " + ctes("fx_exons", "fx_te", "fx_alignments") + ", " + assignment(key, te, strand)


WIDE = lambda table: ", ".join(f"cast(coalesce(sum(n) filter (sample = '{s}'), 0) as bigint) as \"{s}\"" for s in SAMPLES)
GTF = "with " + ctes("fx_gtf_lines") + """, r as (select line_no, c[1] as chrom, c[2] as source, c[3] as feature, cast(c[4] as bigint) as start, cast(c[5] as bigint) as "end", c[7] as strand,
  regexp_extract(c[9], 'gene_id "([^"]*)"', 1) as gene_id, regexp_extract(c[9], 'transcript_id "([^"]*)"', 1) as transcript_id from (select line_no, string_split(value, chr(9)) as c from fx_gtf_lines))"""
LANES = """with o as (select o_orderkey as row, case when o_orderkey % 97 <> 5 then 'S' || cast(floor(o_orderkey / 3) as bigint) end as sample, case when o_orderkey % 89 <> 7 then 'r' || o_orderkey || '_1.fq' end as f1,
  case when o_orderkey % 5 <> 0 then 'r' || o_orderkey || '_2.fq' end as f2, case when o_orderkey % 31 = 3 then 'reverse' else 'forward' end as strandedness, case when o_orderkey % 29 = 4 then 'b' when o_orderkey % 2 = 0 then 'a' end as condition from orders)"""
JOBS = "with " + ctes("fx_metrics") + """, j as (select rule, count(*) as n, avg(s) as sm, max(s) as sx, avg(mean_load / 100) as lm, max(mean_load / 100) as lx, avg(max_rss / 1024) as gm, max(max_rss / 1024) as gx from fx_metrics group by rule),
jr as (select rule, n, round(sm / 3600, 3) as walltime_mean_h, round(sx / 3600, 3) as walltime_max_h, cast(case when rule <> 'click' then length(rule) else 0 end as bigint) as cpu_alloc_cores, round(lm, 3) as cpu_used_mean_cores, round(lx, 3) as cpu_used_max_cores,
  round(case when rule <> 'click' then length(rule) * 1000.0::double else 0.0 end / 1024, 3) as ram_alloc_gb, round(gm, 3) as ram_used_mean_gb, round(gx, 3) as ram_used_max_gb from j),
je as (select *, case when cpu_alloc_cores > 0 then round(cpu_used_mean_cores / cpu_alloc_cores, 3) end as cpu_eff, case when ram_alloc_gb > 0 then round(ram_used_mean_gb / ram_alloc_gb, 3) end as ram_eff from jr)"""
TE_RECORDS = "with " + ctes("fx_te", "fx_gtf_lines")
QC = {"events_total": "true", "events_gene_te": "direction in ('gene_to_te', 'te_to_gene')"}
QC |= {f"direction_{d}": f"direction = '{d}'" for d in DIRECTIONS}
QC |= {f"chimera_type_{k}": f"direction in ('gene_to_te', 'te_to_gene') and chimera_type = '{k}'" for k in ("te_initiated", "te_terminated", "te_exonized", "trans", ".")}
QC |= {"canonical_yes": "canonical = 'yes'", "canonical_no": "canonical = 'no'", "antisense_yes": "antisense_flag = 'yes'"}
QC |= {f"strand_match_{k}": f"direction in ('gene_to_te', 'te_to_gene') and gene_strand_match = '{k}'" for k in ("yes", "no", "NA")}
ANNOTATION = [c.strip() for c in ("donor_chrom, donor_breakpoint, donor_strand, acceptor_chrom, acceptor_breakpoint, acceptor_strand, junction_type, canonical, repeat_flag, direction, gene_id, gene_strand, te_id, te_family, te_class, chimera_type, antisense_flag, library_strand, transcript_strand, gene_strand_match").split(",")]
CATALOG = f"select event_id, min(sample) as first_sample, {', '.join(f'arg_min({c}, sample) as {c}' for c in ANNOTATION)}, count(distinct sample) as n_samples, cast(sum(reads) as bigint) as total_reads from af group by event_id"
OWN_STRAND = "case a.call when 'forward' then f.strand = a.strand when 'reverse' then f.strand = case a.strand when '+' then '-' else '+' end else true end"
CALLED_HITS = INFER + ", " + ctes("fx_sheet", "fx_te") + f", calls as ({RESOLVED}), called_al as (select fx_alignments.*, call from fx_alignments left join calls using (sample)), " + assignment(strand=OWN_STRAND, own="called_al")
UNIQ = " select sample, features[1] as feature, count(*) as n from hits where n = 1 and len(features) = 1 and features[1] <> '__ambiguous' group by all"
MULTI = " select sample, feature, round(sum(w), 6) as weight from (select sample, unnest(features) as feature, 1.0::double / (n * len(features)) as w from hits) where feature <> '__ambiguous' group by all"


#: erfc(x) for x >= 0: the power series up to 2, beyond it the continued fraction from its end.
ERFC = """case when x <= 2 then 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 60), lambda n: (case when n % 2 = 0 then 1 else -1 end) * pow(x, 2 * n + 1) / (gamma(n + 1) * (2 * n + 1))))
  else exp(-x * x) / sqrt(pi()) / (x + list_reduce(list_prepend(0.0::double, list_transform(range(120, 0, -1), lambda n: n::double)), lambda tail, n: n / 2 / (x + tail))) end"""


#: The place of a read's lane in the sheet of its sample: every other sample has lane 2 before lane 1.
PLACE = "(cast(substr(lane, 2) as bigint) + cast(substr(sample, 2) as bigint)) % 2"


def covered(table: str, key: str) -> str:
    return f"""select feature, sum(greatest(0, end0 - greatest(start0, coalesce(before, start0)))) as length from (select {key} as feature, start0, end0,
  max(end0) over (partition by {key}, chrom order by start0, end0 rows between unbounded preceding and 1 preceding) as before from {table}) group by feature"""


LENGTHS = f"""cov as ({covered("fx_exons", "gene_id")} union all {covered("fx_te", "te_id")}),
mean as (select sample, avg(end0 - start0) as m from fx_alignments group by sample),
eff as (select sample, feature, greatest(cast(length as double) - m + 1, 1.0) as length from cov cross join mean)"""


def em_steps(steps: int, lengths: bool = False) -> str:
    """t0 to t{steps}: masses by sample and feature, each step from the one before."""
    size = "coalesce(e.length, 1.0)" if lengths else "1.0::double"
    start = f"""rf as (select sample, read_id, list_sort(list(distinct feature)) as c from (select sample, read_id, unnest(features) as feature from hits) where feature <> '__ambiguous' group by all),
cl as (select sample, c, count(*) as m from rf group by all), x0 as (select sample, array_to_string(c, chr(31)) as class, len(c) as k, m, unnest(c) as feature from cl),
x as (select x0.*, {size} as size from x0 {"left join eff e using (sample, feature)" if lengths else ""}),
t0 as (select sample, feature, sum(m / k::double) as theta from x group by all)"""
    return (LENGTHS + ", " if lengths else "") + start + "".join(
        f", t{i} as materialized (select sample, feature, sum(m * case when total > 0 then part / total else 1.0 / k end) as theta from (select x.*, theta / size as part, sum(theta / size) over (partition by sample, class) as total from x join t{i - 1} using (sample, feature)) group by all)"
        for i in range(1, steps + 1)
    )


SQL: dict[str, str] = {
    "p1_breakpoint_window": "with " + ctes("fx_junctions") + " select line_no, donor_bp - 1 - 2 as start0, donor_bp + 1 + 2 as end0 from fx_junctions",
    "p2_classify_direction": CLASSIFIED + "select sample, direction, count(*) as n, cast(sum(reads) as bigint) as reads from ec group by all",
    "p3_pick_ids": CLASSIFIED + f"select sample, {XY}, direction, gene_id, te_id from ec",
    "p4_gene_side_strand": CLASSIFIED + "select direction, side_strand, count(*) as n from ec group by all",
    "p5_canonical_flag": "with " + ctes("fx_junctions") + " select sample, case when try_cast(junction_type as bigint) between 1 and 6 then 'yes' else 'no' end as canonical, count(*) as n from fx_junctions group by all",
    "p6_require_canonical": annotated(canonical=True) + "select sample, direction, count(*) as n, cast(sum(reads) as bigint) as reads from af group by all",
    "p7_chimera_type": AF + "select direction, gene_strand, chimera_type, count(*) as n from af group by all",
    "p8_strand_evidence": annotated(own_calls=True) + "select sample, library_strand, transcript_strand, gene_strand, gene_strand_match, count(*) as n from af group by all",
    "p9_event_id": AF + "select sample, event_id from af",
    "p10_hits_render": AF + "select sample, event_id, donor_hits, acceptor_hits from af",
    "p11_te_chimera_filter": AF + "select sample, event_id, reads, te_family, te_class from af where direction in ('gene_to_te', 'te_to_gene')",
    "p12_classify_feature_subfamily": CNT + kind(2, "fx_cnt") + " select sample, feature, n, kind, te_family, te_class from k",
    "p13_classify_feature_locus": CNT + kind(3, "fx_cnt") + " select sample, feature, n, kind, te_family, te_class from k",
    "p14_strandedness_call": "with " + ctes("fx_alignments") + ", f as (select sample, chrom, count(*) filter (strand = '+') / count(*)::double as f from fx_alignments group by all) select sample, chrom, case when f >= 0.5 then 'forward' when 1 - f >= 0.5 then 'reverse' else 'no' end as call from f",
    "p15_normalize_strandedness": "select o_orderkey, case o_orderkey % 5 when 0 then 'forward' when 1 then 'reverse' when 2 then 'no' when 3 then 'no' end as call from orders",
    "p16_already_trimmed_check": "select o_orderkey, o_orderkey % 4 <> 3 as trimmed from orders",
    "p17_log2p1": CNT + " select sample, feature, round(log2(n + 1.0), 6) as x from fx_cnt",
    "p18_as_float": "select event_id, case when event_id % 3 = 1 then cast(event_id as double) else 0.0 end as x from events",
    "j1_interval_join_points": CLASSIFIED + "select chrom, bp, array_to_string(ids, ',') as hits from hg",
    "j1_interval_join_tolerance": "with " + ctes("fx_exons", "fx_te", "fx_junctions") + ",\n" + EVENTS + ",\n" + hits(5) + " select chrom, bp, array_to_string(ids, ',') as hits from ht",
    "j2_interval_join_spans": "with " + ctes("fx_exons", "fx_te") + ", " + GENES + " select t.te_id, g.gene_id from fx_te t join genes g on t.chrom = g.chrom and g.start0 < t.end0 and g.end0 > t.start0",
    "j3_left_join_hits": CLASSIFIED + f"select sample, {XY}, array_to_string(dg, ',') as donor_genes, array_to_string(dt, ',') as donor_tes, array_to_string(ag, ',') as acceptor_genes, array_to_string(at_, ',') as acceptor_tes from eh",
    "j4_meta_lookup": WITH_META + f"select sample, {XY}, gene_start, gene_end, gene_strand, te_start, te_end, te_family, te_class from em",
    "j5_antisense_flag": AF + "select direction, antisense_flag, count(*) as n from af group by all",
    "j6_feature_class_filter": "with " + ctes("fx_cnt", "fx_exons") + " select sample, feature, n from fx_cnt where feature in (select gene_id from fx_exons)",
    "j7_condition_lookup": "with " + ctes("fx_junctions", "fx_sheet") + " select s.sample, case when s.sample in ('S4', 'S5') then 'all' else coalesce(f.condition, 'all') end as condition from (select distinct sample from fx_junctions) s left join fx_sheet f using (sample)",
    "j8_contrast_pairs": "with " + ctes("fx_sheet") + ", " + CONTRAST + " select contrast, sample, role from ct",
    "j9_strandedness_resolve": INFER + ", " + ctes("fx_sheet") + " " + RESOLVED,
    "j10_allocated_join": JOBS + " select rule, cpu_alloc_cores, ram_alloc_gb, cpu_eff, ram_eff from je",
    "j11_dense_grid": GRID + " select feature, sample, n from g",
    "a1_collapse_events": "with " + ctes("fx_junctions") + ", " + EVENTS + f" select sample, {XY}, junction_type, repeat_flag, reads from ev",
    "a2_gene_spans": GTF + ' select arg_max(chrom, line_no) as chrom, min(start) - 1 as start0, max("end") as end0, gene_id, arg_min(strand, line_no) as strand from r group by gene_id',
    "a3_te_loci": TE_RECORDS + " select arg_min(chrom, te_id) as chrom, min(start0) as start0, max(end0) as end0, te_family as te_id, arg_min(strand, te_id) as strand, te_family, arg_min(te_class, te_id) as te_class from fx_te group by te_family",
    "a3_te_copies": TE_RECORDS + " select chrom, start0, end0, te_id, strand, te_family, te_class from fx_te",
    "a4_exon_track": GTF + ' select chrom, start - 1 as start0, "end" as end0, gene_id, strand from r where feature = \'exon\'',
    "a5_transcript_blocks": GTF + """ , e as (select *, min(start) over (partition by transcript_id) as first from r where feature = 'exon')
  select arg_min(chrom, line_no) as chrom, min(start) - 1 as start0, max("end") as end0, transcript_id, arg_min(strand, line_no) as strand, string_agg(cast(start - first as varchar), ',' order by start, "end") as starts, string_agg(cast("end" - start + 1 as varchar), ',' order by start, "end") as sizes from e group by transcript_id""",
    "a6_feature_keys": GTF + ", " + ctes("fx_te") + " select distinct gene_id as feature from r union select distinct te_family || ':' || te_family || ':' || te_class from fx_te",
    "a7_event_catalog": AF + CATALOG,
    "a8_event_counts_matrix": AF + f"select feature, {WIDE('x')} from (select event_id as feature, sample, reads as n from af) group by feature",
    "a9_te_catalog": AF + f"select event_id, n_samples, total_reads, chimera_type from ({CATALOG}) where direction in ('gene_to_te', 'te_to_gene')",
    "a10_junction_qc": AF + " union all ".join(f"select sample, '{name}' as metric, count(*) filter ({test}) as value from af group by sample" for name, test in QC.items()),
    "a11_direction_composition": CLASSIFIED.rstrip() + ", " + long_counts("ec", "direction", DIRECTIONS) + f" select sample, direction, n, {pct('n', 'sum(n) over (partition by sample)')} as pct from l",
    "a12_te_chimera_composition": CLASSIFIED.rstrip() + ", " + long_counts("ec", "direction", DIRECTIONS[:2]) + f", t as (select sample, count(*) as total from ec group by sample) select sample, direction, n, {pct('n', 'total')} as pct from l join t using (sample)",
    "a13_feature_matrix": CNT + f" select feature, {WIDE('x')} from fx_cnt group by feature",
    "a14_assignment_summary": CNT + kind(2, "fx_cnt") + ", " + long_counts("k", "kind", ("gene", "TE"), "cast(sum(x.n) as bigint)") + f" select sample, kind, n, {pct('n', 'sum(n) over (partition by sample)')} as pct from l",
    "a15_te_class_summary": CNT + kind(2, "fx_cnt") + ", " + long_counts("k", "te_class", ("LINE", "SINE", "LTR", "DNA", "RC", "unknown"), "cast(sum(x.n) as bigint)") + f" select sample, te_class, n, {pct('n', 'sum(n) over (partition by sample)')} as pct from l",
    "a16_locus_assignment_summary": LOCI + kind(3, "c") + ", " + long_counts("k", "kind", ("gene", "TE"), "cast(sum(x.n) as bigint)") + f" select sample, kind, n, {pct('n', 'sum(n) over (partition by sample)')} as pct from l",
    "a16_locus_class_summary": LOCI + kind(3, "c") + ", " + long_counts("k", "te_class", ("LINE", "SINE", "LTR", "DNA", "RC", "unknown"), "cast(sum(x.n) as bigint)") + f" select sample, te_class, n, {pct('n', 'sum(n) over (partition by sample)')} as pct from l",
    "a17_qc_presence_filter": CNT + " select * from fx_cnt where feature in (select feature from fx_cnt group by feature having count(distinct sample) filter (n > 0) >= 3 and sum(n) >= 500)",
    "a18_zero_variance_filter": GRID + " select feature, sample, round(x, 6) as x from lg where feature in (select feature from lg group by feature having max(x) > min(x))",
    "a19_min_events_gate": GRID + " select feature, sample, round(x, 6) as x from lg where (select count(distinct sample) from lg) >= 2 and (select count(distinct feature) from lg) >= 100",
    "a20_sample_distances": GRID + " select a.sample as sample_a, b.sample as sample_b, round(sqrt(sum((a.x - b.x) * (a.x - b.x))), 6) as distance from lg a join lg b using (feature) group by all",
    "a22_lane_group": LANES + " select sample, coalesce(string_agg(f1, ',' order by row), '') as fastq_1, coalesce(string_agg(f2, ',' order by row), '') as fastq_2, max(strandedness) as strandedness, max(condition) as condition from o where sample is not null group by sample",
    "a23_sheet_violations": LANES + """, b as (select sample, count(*) as n, count(*) - count(f1) as m1, count(distinct strandedness) as st, count(distinct condition) as co, count(f1) as c1, count(f2) as c2 from o group by sample)
  select sample, 'missing_sample' as rule, n from b where sample is null union all select sample, 'missing_fastq_1', m1 from b where m1 > 0 union all select sample, 'strandedness_conflict', st - 1 from b where st > 1
  union all select sample, 'condition_conflict', co - 1 from b where co > 1 union all select sample, 'mate_count', abs(c1 - c2) from b where c2 > 0 and c1 <> c2""",
    "a24_has_condition": "with " + ctes("fx_sheet") + " select coalesce(bool_and(condition is not null), false) as has_condition from fx_sheet",
    "a25_contrast_replicates": "with " + ctes("fx_sheet") + ", " + CONTRAST + " select contrast, role, count(*) as n, count(*) < 2 as warning from ct group by all",
    "a26_contrast_strandedness": INFER + ", " + ctes("fx_sheet") + ", " + CONTRAST + f", calls as ({RESOLVED}) select contrast, count(distinct call) as n_calls, string_agg(distinct call, ',' order by call) as calls from ct join calls using (sample) group by contrast having count(distinct call) > 1",
    "a27_max_read_length": "with " + ctes("fx_reads") + " select sample, max(length(seq)) as max_length, max(length(seq)) - 1 as overhang from (select *, row_number() over (partition by sample, lane order by read_id) as k from fx_reads) where k <= 20 group by sample",
    "a28_gtf_feature_count": "with " + ctes("fx_gtf_lines") + " select 'f' || line_no % 3 as file, count(*) filter (line_no % 3 <> 2) as n, count(*) filter (line_no % 3 <> 2) = 0 as warning from fx_gtf_lines group by 1",
    "a29_nonempty_reads": "with " + ctes("fx_reads") + " select sample, count(distinct lane) as n_files, count(*) filter (lane = 'L1') as n_reads, count(*) filter (lane = 'L1') > 0 as ok from fx_reads group by sample",
    "a30_job_resource_summary": JOBS + " select * from je",
    "a31_repeat_flagged": AF + "select sample, count(*) filter (repeat_flag <> '0') as repeat_flagged from af group by sample",
    "a31_top_families": AF + ", f as (select sample, te_family, count(*) as n from af where direction in ('gene_to_te', 'te_to_gene') and te_family <> '.' group by all) select * from (select sample, row_number() over (partition by sample order by n desc, te_family) as rank, te_family, n from f) where rank <= 5",
    "a31_top_classes": AF + ", f as (select sample, te_class, count(*) as n from af where direction in ('gene_to_te', 'te_to_gene') and te_class <> '.' group by all) select * from (select sample, row_number() over (partition by sample order by n desc, te_class) as rank, te_class, n from f) where rank <= 3",
    "q1_infer_strandedness": INFER + " select sample, n_reads, round(forward, 6) as forward, round(reverse, 6) as reverse, round(1 - forward - reverse, 6) as undetermined, call from called",
    "q2_quantify_uniq": assigned() + UNIQ,
    "q2_quantify_uniq_forward": assigned(strand="f.strand = a.strand") + UNIQ,
    "q2_quantify_uniq_by_call": CALLED_HITS + UNIQ,
    "q3_quantify_multi": assigned() + MULTI,
    "q3_quantify_multi_by_call": CALLED_HITS + MULTI,
    "q4_quantify_em": assigned() + ", " + em_steps(10) + " select sample, feature, round(theta, 3) as theta from t10",
    "q4_quantify_em_lengths": assigned() + ", " + em_steps(10, True) + " select sample, feature, round(theta, 2) as theta, round(coalesce(1e6 * (theta / length) / sum(theta / length) over (partition by sample), 0), 2) as tpm from t10 join eff using (sample, feature)",
    "q4_effective_lengths": "with " + ctes("fx_exons", "fx_te", "fx_alignments") + ", " + LENGTHS + " select sample, feature, round(length, 6) as length from eff",
    "q4_em_likelihood": assigned() + ", " + em_steps(9, True) + " select sample, round(sum(m * ln(total)), 2) as log_likelihood from (select sample, class, m, sum(theta / size) as total from x join t9 using (sample, feature) group by all) group by sample",
    "q5_quantify_locus": assigned("locus", "loc") + MULTI,
    "q5_locus_uniq": assigned("locus", "loc") + UNIQ,
    "q5_locus_em": assigned("locus", "loc") + ", " + em_steps(10) + " select sample, feature, round(theta, 3) as theta from t10",
    "q6_size_factors": FACTORS + " select sample, round(size_factor, 6) as size_factor from sf",
    "q7_dispersions": FACTORS + " select feature, round(mu, 6) as mu, round(alpha, 6) as alpha from dp",
    "q8_contrast_effects": EFFECTS + " select contrast, feature, round(base_mean, 6) as base_mean, round(log2fc, 6) as log2fc, round(z, 6) as z from ef",
    "q8_adjusted_p": EFFECTS + """, p as (select contrast, feature, round(1 / (1 + abs(z)), 4) as pvalue from ef), rk as (select *, count(*) over (partition by contrast) as m, row_number() over (partition by contrast order by pvalue, feature) as i from p)
  select contrast, feature, pvalue, round(least(1.0, min(pvalue * m / i) over (partition by contrast order by pvalue desc, feature desc rows between unbounded preceding and current row)), 6) as padj from rk""",
    "q8_diff_contrast": EFFECTS + f""", p as (select *, {ERFC} as pvalue from (select *, abs(z) / sqrt(2) as x from ef)), rk as (select *, count(*) over (partition by contrast) as m, row_number() over (partition by contrast order by pvalue, feature) as i from p),
  ad as (select *, least(1.0, min(pvalue * m / i) over (partition by contrast order by pvalue desc, feature desc rows between unbounded preceding and current row)) as padj from rk)
  select contrast, feature, round(base_mean, 6) as base_mean, round(log2fc, 6) as log2fc, round(z, 6) as z, round(pvalue, 6) as pvalue, round(padj, 6) as padj, padj < 0.05 as significant from ad""",
    "q9_lane_merge": "with " + ctes("fx_reads") + f" select sample, mate, cast({PLACE} as int) as place, read_id as pos, read_id from fx_reads",
    "q9_merged_files": "with " + ctes("fx_reads") + f" select sample, mate, row_number() over (partition by sample, mate order by {PLACE}, read_id) as at, read_id from fx_reads",
    "q10_read_qc": "with " + ctes("fx_reads") + """ select sample, mate, count(*) as n_reads, cast(sum(length(seq)) as bigint) as n_bases, min(length(seq)) as min_length, max(length(seq)) as max_length, round(100.0 * sum(length(regexp_replace(seq, '[^GCgc]', '', 'g'))) / sum(length(seq)), 6) as gc_pct,
  round(100.0 * sum(length(regexp_replace(seq, '[^Nn]', '', 'g'))) / sum(length(seq)), 6) as n_pct from fx_reads group by sample, mate""",
    "q10_position_quality": "with " + ctes("fx_reads") + """ select sample, mate, pos - 1 as pos, count(*) as n, round(avg(ascii(substr(qual, pos, 1)) - 33), 6) as mean_quality, round(100.0 * count(*) filter (substr(seq, pos, 1) = 'N') / count(*), 6) as n_pct
  from (select sample, mate, seq, qual, unnest(range(1, length(qual) + 1)) as pos from fx_reads) group by all""",
    "q10_length_distribution": "with " + ctes("fx_reads") + " select sample, mate, length(seq) as length, count(*) as n from fx_reads group by all",
    "s1_gtf_records": GTF + ' select line_no, chrom, source, feature, start, "end", strand, gene_id, transcript_id from r',
    "s3_gtf_attrs_quoted": GTF + " select line_no, gene_id, transcript_id from r",
    "s10_infer_report": INFER + ", c as (select sample, round(forward, 4) as forward, round(reverse, 4) as reverse from inf) select sample, forward, reverse, case when forward >= 0.6 then 'forward' when reverse >= 0.6 then 'reverse' else 'no' end as call from c",
    "s15_te_chimeras": AF + "select * from af where direction in ('gene_to_te', 'te_to_gene')",
    "s16_igv_bed": AF + "select sample, donor_chrom as chrom, least(donor_breakpoint - 1, acceptor_breakpoint) as start0, greatest(donor_breakpoint - 1, acceptor_breakpoint) as end0, event_id as name, reads as score, donor_strand as strand from af where direction in ('gene_to_te', 'te_to_gene')",
    "e2_annotate_junctions": annotated(tol=2) + "select * from af",
    "e2_annotate_cis_only": annotated(cis=True) + "select sample, chimera_type, count(*) as n from af group by all",
}

PLACES = "donor_chrom, donor_breakpoint, donor_strand, acceptor_chrom, acceptor_breakpoint, acceptor_strand"
BED = "with " + ctes("fx_te") + " select chrom, start0, end0, te_id as id, '0' as score, strand, te_family, te_class from fx_te"
READS = "with " + ctes("fx_reads") + " select sample, lane, read_id, seq, qual from fx_reads"
JUNCTION = "donor_chrom, donor_bp, donor_strand, acceptor_chrom, acceptor_bp, acceptor_strand, junction_type, repeat_flag"
SQL |= {
    "s4_read_bed": BED,
    "s14_gzip_bed": BED,
    "o1_bed_order": "with " + ctes("fx_te") + " select chrom, row_number() over (partition by chrom order by start0, end0, te_id) as at, te_id from fx_te",
    "s6_read_junctions": "with " + ctes("fx_junctions") + f" select sample, {JUNCTION}, count(*) as n from fx_junctions group by all",
    "s7_read_events": AF + "select * from af",
    "o2_event_order": AF + f"select sample, row_number() over (partition by sample order by {PLACES}, direction) as at, event_id from af",
    "o3_catalog_order": AF + f"select direction, row_number() over (partition by direction order by first_sample, event_id) as at, event_id from ({CATALOG})",
    "s8_read_count_tables": "with " + ctes("fx_cnt") + " select sample, feature, n from fx_cnt",
    "s9_read_sample_sheet": LANES + " select row_number() over (order by row) - 1 as row, sample, f1 as fastq_1, f2 as fastq_2, strandedness, condition from o",
    "s11_read_fastq": READS,
    "s11_read_fastq_gz": READS,
    "s12_read_job_metrics": "with " + ctes("fx_metrics") + " select rule, count(*) as n, round(sum(s), 4) as s, round(sum(max_rss), 4) as max_rss, round(sum(mean_load), 4) as mean_load from fx_metrics group by rule",
    "s13_read_metrics": f"select sample, metric, cast(value as varchar) as value from ({SQL['a10_junction_qc']})",
    "s16_track_lines": f"""with rows as ({SQL['s16_igv_bed']}), lines as (select sample, 1 as k, chrom, start0, concat_ws(chr(9), chrom, start0, end0, name, score, strand) as value from rows
  union all select distinct sample, 0, '', -1, 'track name="chimera_junctions" description="gene-TE chimera junctions (' || sample || ')" itemRgb="On"' from rows)
  select sample, row_number() over (partition by sample order by k, chrom, start0, value) as at, value from lines""",
    "s17_write_matrix": "with " + ctes("fx_cnt") + f" select feature, {WIDE('x')} from fx_cnt group by feature",
    "o4_matrix_order": "with " + ctes("fx_cnt") + " select substr(feature, 1, 1) as by, row_number() over (partition by substr(feature, 1, 1) order by feature) as at, feature from (select distinct feature from fx_cnt)",
    "o5_rule_order": JOBS + " select row_number() over (order by case when rule = 'click' then 1073741824 else length(rule) end, rule) as at, rule from je",
}
