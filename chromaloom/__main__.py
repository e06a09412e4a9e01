"""Command line, for example::

    python -m chromaloom --reference ref.fa --sites Arima_v2 --sam reads.bam --out valid-pairs=valid.bam:sort --out dumped=rest
    python -m chromaloom --reference ref.fa --sites DpnII --fastq r1.fq.gz r2.fq.gz --aligner my.module:align --trim --index index --save-stats stats
"""

from __future__ import annotations

import argparse
import importlib
import logging

from pyspark.sql import SparkSession

from .functions.alignments import OUTPUTS
from .plans.facade import Aligner, Pipeline


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="chromaloom", description="Classify aligned Hi-C reads and summarise their contacts.")
    out.add_argument("--reference", required=True, help="FASTA file, plain, gzip or bzip2")
    out.add_argument("--sites", required=True, help="comma-separated sites, enzymes or kits; DNASE for none")
    out.add_argument("--enzymes", help="table of further enzymes, in REBASE's EMBOSS form")
    out.add_argument("--index", help="folder in which digests are kept and looked up")
    out.add_argument("--dense", action="store_true", help="save the dense frame of contacts, too")
    out.add_argument("--min-mapq", type=int, default=10)
    out.add_argument("--save-stats", help="folder for the tables of statistics")
    source = out.add_mutually_exclusive_group(required=True)
    source.add_argument("--sam", help="aligned reads: SAM text or BAM")
    source.add_argument("--fastq", nargs="+", metavar="FILE", help="one interleaved or two FASTQ files, to be aligned by --aligner")
    source.add_argument("--sam-reads", help="SAM text or BAM whose primary reads are aligned anew by --aligner")
    source.add_argument("--index-only", action="store_true", help="only write the digest with overhangs to --index (or --save-stats)")
    out.add_argument("--aligner", metavar="MODULE:FUNCTION", help="takes reads and sequences as DataFrames and returns records")
    out.add_argument("--trim", action="store_true", help="align to the digest first and clip reads to their fragment")
    out.add_argument("--keep-tag", action="append", default=[], help="optional field of --sam-reads that is handed to the aligner")
    out.add_argument("--mark-duplicates", action="store_true")
    out.add_argument(
        "--out", action="append", default=[], metavar="NAME=PATH[:sort]",
        help="an output of " + ", ".join(OUTPUTS) + "; .sam is text, .bam BAM, all else Parquet; :sort orders it by coordinate and indexes BAM",
    )
    out.add_argument("--sort", action="store_true", help="sort all outputs by coordinate")
    return out


def aligner_of(name: str) -> Aligner:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def main(argv: list[str] | None = None) -> None:
    options = parser()
    args = options.parse_args(argv)
    aligned = bool(args.fastq or args.sam_reads)
    if aligned != bool(args.aligner):
        options.error("--aligner belongs to --fastq and --sam-reads")
    if (args.trim or args.keep_tag) and not aligned:
        options.error("--trim and --keep-tag belong to --fastq and --sam-reads")
    logging.basicConfig(level=logging.INFO)
    pipeline = Pipeline(SparkSession.builder.appName("chromaloom").getOrCreate())
    pipeline.reference, pipeline.restriction_sites, pipeline.min_mapq = args.reference, args.sites, args.min_mapq
    pipeline.dense_contacts = args.dense
    for name, value in (("enzymes", args.enzymes), ("save_stats_path", args.save_stats), ("index_path", args.index)):
        if value:
            setattr(pipeline, name, value)
    if args.index_only:
        pipeline.register_alignment_index_only()
    elif args.fastq:
        pipeline.register_alignment(args.fastq, aligner_of(args.aligner), args.trim, args.mark_duplicates)
    elif args.sam_reads:
        pipeline.register_alignment_sam_reads(args.sam_reads, aligner_of(args.aligner), args.keep_tag or None, args.trim, args.mark_duplicates)
    else:
        pipeline.register_sam_input(args.sam, args.mark_duplicates)
    for item in args.out:
        name, _, path = item.partition("=")
        sort = path.endswith(":sort")
        pipeline.register_output_file(path.removesuffix(":sort"), [name], sort or args.sort)
    stats = pipeline.run()
    if stats is not None:
        for row in stats.reads.collect():
            logging.info("%s: %d", row["type"], row["counts"])


if __name__ == "__main__":
    main()
