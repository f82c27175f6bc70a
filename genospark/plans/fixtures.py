"""Views of the driver's tables that have the shapes of RNA-seq inputs; the SQL runs unchanged in Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SOURCES = {
    "fx_exons": "part",
    "fx_te": "part",
    "fx_junctions": "lineitem",
    "fx_cnt": "lineitem",
    "fx_alignments": "lineitem",
    "fx_reads": "events",
    "fx_metrics": "events",
    "fx_gtf_lines": "part",
    "fx_sheet": "orders",
}

VIEWS = {
    "fx_exons": """
select concat('chr', cast(cast(floor(p_partkey/4) as bigint) % 5 + 1 as string)) as chrom,
       cast(floor(cast(floor(p_partkey/4) as bigint)/5) as bigint)*400 + (p_partkey % 4)*120 as start0,
       cast(floor(cast(floor(p_partkey/4) as bigint)/5) as bigint)*400 + (p_partkey % 4)*120 + 30 + p_size as end0,
       concat('G', lpad(cast(cast(floor(p_partkey/4) as bigint) as string), 6, '0')) as gene_id,
       case when (cast(floor(p_partkey/4) as bigint) + cast(floor(p_partkey/20) as bigint)) % 2 = 0 then '+' else '-' end as strand
from part where p_partkey % 4 <> 3
""",
    "fx_te": """
select concat('chr', cast(cast(floor(p_partkey/4) as bigint) % 5 + 1 as string)) as chrom,
       cast(floor(p_partkey/20) as bigint)*400 + (p_size % 9)*50 as start0,
       cast(floor(p_partkey/20) as bigint)*400 + (p_size % 9)*50 + 60 as end0,
       concat('TE', lpad(cast(p_partkey as string), 7, '0')) as te_id,
       case when p_partkey % 8 = 3 then '+' else '-' end as strand,
       replace(p_brand, '#', '') as te_family,
       case p_partkey % 6 when 0 then 'LINE' when 1 then 'SINE' when 2 then 'LTR' when 3 then 'DNA' when 4 then 'RC' else 'Satellite' end as te_class
from part where p_partkey % 4 = 3 or p_partkey % 12 = 1
""",
    "fx_junctions": """
select concat('S', cast(l_orderkey % 6 as string)) as sample,
       l_orderkey*100000000 + l_partkey*10 + l_linenumber as line_no,
       concat('chr', cast(cast(floor(l_partkey/4) as bigint) % 5 + 1 as string)) as donor_chrom,
       cast(floor(l_partkey/20) as bigint)*400 + (l_linenumber % 4)*100 + 15 as donor_bp,
       case l_linestatus when 'O' then '+' else '-' end as donor_strand,
       concat('chr', cast((cast(floor(l_partkey/4) as bigint) + l_suppkey % 3) % 5 + 1 as string)) as acceptor_chrom,
       cast(floor((l_partkey + 4*(l_suppkey % 3))/20) as bigint)*400 + (l_suppkey % 4)*90 + 25 as acceptor_bp,
       case l_linestatus when 'O' then '+' else '-' end as acceptor_strand,
       cast((l_partkey % 4) - 1 as string) as junction_type,
       cast(l_linenumber % 3 as string) as repeat_flag
from lineitem
""",
    "fx_cnt": """
select concat('S', cast(l_orderkey % 6 as string)) as sample,
       case when l_partkey % 3 = 0
            then concat('G', lpad(cast(cast(floor(l_partkey/4) as bigint) as string), 6, '0'))
            else concat('SF', cast(l_partkey % 211 as string), ':', 'FAM', cast(l_partkey % 17 as string), ':',
                 case l_partkey % 6 when 0 then 'LINE' when 1 then 'SINE' when 2 then 'LTR' when 3 then 'DNA' when 4 then 'RC' else 'Satellite' end)
       end as feature,
       cast(sum(cast(l_quantity as bigint)) as bigint) as n
from lineitem group by 1, 2
""",
    "fx_alignments": """
select concat('S', cast(l_orderkey % 6 as string)) as sample, l_orderkey as read_id,
       concat('chr', cast(cast(floor(l_partkey/4) as bigint) % 5 + 1 as string)) as chrom,
       cast(floor(l_partkey/20) as bigint)*400 + (l_suppkey*13 + l_linenumber*29) % 400 as start0,
       cast(floor(l_partkey/20) as bigint)*400 + (l_suppkey*13 + l_linenumber*29) % 400 + 50 as end0,
       case when l_suppkey % 10 < 7 then (case when (cast(floor(l_partkey/4) as bigint) + cast(floor(l_partkey/20) as bigint)) % 2 = 0 then '+' else '-' end)
            else (case when (cast(floor(l_partkey/4) as bigint) + cast(floor(l_partkey/20) as bigint)) % 2 = 0 then '-' else '+' end) end as strand
from lineitem
""",
    "fx_reads": """
select concat('S', cast(event_id % 6 as string)) as sample, concat('L', cast(cast(floor(event_id/6) as bigint) % 2 + 1 as string)) as lane, concat('R', cast(cast(floor(event_id/12) as bigint) % 2 + 1 as string)) as mate, event_id as read_id,
       substr(translate(md5(cast(event_id as string)), '0123456789abcdef', 'ACGTACGTACGTACGN'), 1, cast(20 + event_id % 13 as int)) as seq,
       substr(translate(md5(cast(event_id + 1 as string)), '0123456789abcdef', 'IIIIHHHGGFFEDB5#'), 1, cast(20 + event_id % 13 as int)) as qual
from events
""",
    "fx_metrics": """
select event_type as rule, event_id as job, value as s, value*37.5 as max_rss, value*11.0 as mean_load from events
""",
    "fx_gtf_lines": """
select p_partkey as line_no,
       concat(concat('chr', cast(cast(floor(p_partkey/4) as bigint) % 5 + 1 as string)), chr(9), 'src', chr(9),
              case when p_partkey % 4 = 0 then 'gene' else 'exon' end, chr(9),
              cast(cast(floor(p_partkey/20) as bigint)*400 + (p_partkey % 4)*120 + 1 as string), chr(9),
              cast(cast(floor(p_partkey/20) as bigint)*400 + (p_partkey % 4)*120 + 30 + p_size as string), chr(9), '.', chr(9),
              case when (cast(floor(p_partkey/4) as bigint) + cast(floor(p_partkey/20) as bigint)) % 2 = 0 then '+' else '-' end, chr(9), '.', chr(9),
              'gene_id "G', lpad(cast(cast(floor(p_partkey/4) as bigint) as string), 6, '0'), '"; transcript_id "T', cast(cast(floor(p_partkey/8) as bigint) as string), '";') as value
from part
""",
    "fx_sheet": """
select concat('S', cast(o_orderkey as string)) as sample, concat('reads/S', cast(o_orderkey as string), '_L1_R1.fastq.gz') as fastq_1,
       case when o_orderkey % 2 = 0 then concat('reads/S', cast(o_orderkey as string), '_L1_R2.fastq.gz') end as fastq_2,
       case o_orderkey % 3 when 0 then 'forward' when 1 then 'reverse' else 'unstranded' end as strandedness,
       case when o_orderkey < 3 then 'control' else 'treatment' end as condition
from orders
""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table = SOURCES[name]
    sql = re.sub(rf"\bfrom {table}\b", f"from {{{table}}}", VIEWS[name])
    return spark.sql(sql, **{table: spark.read.parquet(f"{sf_dir}/{table}.parquet")})


def ctes(*names: str) -> str:
    """The views as the beginning of a WITH clause."""
    return ",\n".join(f"{n} as ({VIEWS[n]})" for n in names)
