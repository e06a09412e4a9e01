"""The pipeline as an object: settings that are given once, an input, outputs, and ``run``."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sites import RestrictionSite, compile_sites, read_catalogue
from ..operators import digest, models, pairs, reads, stats
from ..operators import trim as trimming
from ..operators.index import DigestIndex
from ..operators.tables import Workspace
from ..sources import blocks, files, header, sinks


#: Takes reads (qname, mate, seq, qual, comment) and sequences (seq_idx, name, seq); returns records as read_sam gives them.
Aligner = Callable[[DataFrame, DataFrame], DataFrame]


class SettingError(ValueError):
    """A setting that is missing, or given twice with different values."""


@dataclass
class Stats:
    """Statistics of a run: every property is a DataFrame over the written records, computed when it is read."""

    classified: DataFrame
    pairs: DataFrame
    sequences: DataFrame
    #: Whether ``tables`` and ``save`` include the dense frame, whose size is the square of the sequences'.
    dense: bool = False

    @property
    def reads(self) -> DataFrame:
        return stats.read_summary(self.classified, self.pairs)

    @property
    def pair_counts(self) -> DataFrame:
        return stats.pair_summary(self.pairs)

    @property
    def intra_inter(self) -> DataFrame:
        return stats.intra_inter(self.pairs)

    @property
    def contacts(self) -> DataFrame:
        return stats.contact_matrix(self.pairs)

    @property
    def sequence_stats(self) -> DataFrame:
        return stats.sequence_stats(self.pairs, self.sequences)

    @property
    def valid_pairs(self) -> DataFrame:
        return stats.valid_pairs_dense(self.contacts, self.sequences)

    @property
    def inter_sequence_index(self) -> DataFrame:
        return stats.inter_sequence_index(self.contacts, self.sequences)

    @property
    def site_distances(self) -> DataFrame:
        return stats.site_distance_frame(self.pairs)

    @property
    def read_separations(self) -> DataFrame:
        return stats.separations(self.pairs, "pair_sep")

    @property
    def fragment_separations(self) -> DataFrame:
        return stats.separations(self.pairs, "frag_sep")

    def pair_count(self, one: str, two: str, kind: str = "total", norm: bool = False) -> DataFrame:
        return stats.pair_count(self.valid_pairs, one, two, kind, norm)

    def tables(self) -> dict[str, DataFrame]:
        out = {
            "reads": self.reads, "hic_pairs": self.pair_counts, "intra_inter": self.intra_inter, "per_sequence": self.sequence_stats,
            "inter_sequence_indexes": self.inter_sequence_index, "contacts": self.contacts, "restriction_sites": self.site_distances,
        }
        if self.dense:
            out["valid_pairs"] = self.valid_pairs
        for name, frame in (("read_separations", self.read_separations), ("fragment_separations", self.fragment_separations)):
            out[name] = frame
            out[f"{name}_models"], out[f"{name}_f_tests"] = models.contact_models(frame)
        return out

    def save(self, path: str, form: str = "parquet") -> None:
        """One folder per table, as Parquet or bzip2 CSV; failures are raised."""
        for name, table in self.tables().items():
            if form == "csv":
                sinks.write_csv(table, f"{path}/{name}")
            else:
                table.write.mode("overwrite").parquet(f"{path}/{name}")


def load_stats(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    """Tables of a saved run."""
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}


class Pipeline:
    """Reference, restriction sites and reads in; classified reads and statistics out."""

    def __init__(self, spark: SparkSession, logger: logging.Logger | None = None, exception_callback: Callable[[Exception], None] | None = None):
        self.spark = spark
        self.logger = logger or logging.getLogger(__name__)
        self.exception_callback = exception_callback
        self._set: dict[str, object] = {}
        self._outputs: dict[str, tuple[list[str], bool]] = {}
        self._input: Callable[[], DataFrame] | None = None
        self._index_only = False
        self._header: list[str] = []
        self.malformed = 0  # lines of the input that were no records

    def _once(self, name: str, value: object) -> None:
        if self._set.setdefault(name, value) != value:
            raise SettingError(f"{name} is {self._set[name]} already")

    def _needed(self, name: str) -> object:
        if name not in self._set:
            raise SettingError(f"{name} is not set")
        return self._set[name]

    reference = property(lambda self: self._needed("reference"), lambda self, v: self._once("reference", v))
    restriction_sites = property(lambda self: self._needed("restriction_sites"), lambda self, v: self._once("restriction_sites", v))
    min_mapq = property(lambda self: self._set.get("min_mapq", reads.MIN_MAPQ), lambda self, v: self._once("min_mapq", v))
    save_stats_path = property(lambda self: self._set.get("save_stats_path"), lambda self, v: self._once("save_stats_path", v))
    enzymes = property(lambda self: self._set.get("enzymes"), lambda self, v: self._once("enzymes", v))  # path of a table for read_catalogue
    index_path = property(lambda self: self._set.get("index_path"), lambda self, v: self._once("index_path", v))  # folder of digests that are read again
    dense_contacts = property(lambda self: self._set.get("dense_contacts", False), lambda self, v: self._once("dense_contacts", v))
    threads = property(lambda self: self._set.get("threads"), lambda self, v: self._once("threads", v))

    def register_reads(self, records: DataFrame) -> None:
        """Aligned records as a table."""
        self._once("input", "table")
        self._input = lambda: records

    def register_sam_input(self, path: str, mark_duplicates: bool = False) -> None:
        """Aligned records from SAM text or BAM."""
        self._once("input", path)

        def read() -> DataFrame:
            records, self._header = self._records(path)
            return pairs.mark_duplicates(records) if mark_duplicates else records

        self._input = read

    def _records(self, path: str) -> tuple[DataFrame, list[str]]:
        """Records and header lines of SAM text or BAM; malformed lines are counted."""
        if path.endswith(".bam"):
            return files.read_bam(self.spark, path), files.read_bam_header(self.spark, path)
        records, head, malformed = files.read_sam(self.spark, path)
        self.malformed = malformed.count()
        if self.malformed:
            self.logger.warning("%s: %d malformed lines are left out", path, self.malformed)
        return records, [r["value"] for r in head.orderBy("line_no").collect()]

    def register_alignment(self, paths: list[str], aligner: Aligner, trim: bool = False, mark_duplicates: bool = False) -> None:
        """FASTQ files (one interleaved, or two) and a function that aligns them.

        ``aligner`` takes the reads (qname, mate, seq, qual, comment) and the genome, and returns records.
        ``trim`` aligns to the digest first and clips reads to their fragment.
        """
        if not 1 <= len(paths) <= 2:
            raise SettingError("one or two files of reads are expected")
        self._once("input", tuple(paths))

        def read() -> DataFrame:
            parts = [files.read_fastq(self.spark, p, mate=i + 1 if len(paths) == 2 else None) for i, p in enumerate(paths)]
            records = self._align(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), aligner, trim)
            return pairs.mark_duplicates(records) if mark_duplicates else records

        self._input = read

    def register_alignment_sam_reads(self, path: str, aligner: Aligner, keep_tags: list[str] | None = None, trim: bool = False, mark_duplicates: bool = False) -> None:
        """Primary records of a SAM or BAM file, aligned anew; its @PG and @RG lines go to the outputs."""
        self._once("input", path)

        def read() -> DataFrame:
            records, head = self._records(path)
            self._header = [x for x in head if x.startswith(("@PG\t", "@RG\t"))]
            records = self._align(files.sam_to_fastq(records, keep_tags), aligner, trim, keep_tags)
            return pairs.mark_duplicates(records) if mark_duplicates else records

        self._input = read

    def register_alignment_index_only(self) -> None:
        """Only digest the reference; ``run`` gives nothing."""
        self._once("input", "index only")
        self._index_only = True

    def register_output_file(self, path: str, classes: list[str], sort: bool = False) -> None:
        """Send classes or groups of classes to a folder (.sam: text; .bam: BAM parts, with an index each if sorted; otherwise Parquet)."""
        known, sorted_before = self._outputs.get(path, ([], False))
        self._outputs[path] = (known + classes, sort or sorted_before)
        try:
            sinks.check_routes({p: c for p, (c, _) in self._outputs.items()})
        except sinks.RouteError:
            self._outputs[path] = (known, sorted_before)
            raise

    def sites(self) -> frozenset[RestrictionSite]:
        lines = [r[0] for r in self.spark.read.text(str(self.enzymes)).collect()] if self.enzymes else []  # some thousand at most
        return compile_sites(str(self.restriction_sites), catalogue=read_catalogue(lines))

    def chunks(self) -> DataFrame:
        """The reference in chunks; a file is cut where its lines stand, without a row per sequence."""
        ref, reach = self.reference, digest.reach_of(self.sites())
        return digest.chunked(ref, reach=reach) if isinstance(ref, DataFrame) else blocks.fasta_chunks(self.spark, str(ref), digest.CHUNK, reach)

    def _index(self, sites: frozenset[RestrictionSite]) -> DigestIndex | None:
        """Digests of this reference on disk; a reference that is a table has no name to keep them under."""
        root = self.index_path or (self.save_stats_path if self._index_only else None)
        return DigestIndex(self.spark, str(root), str(self.reference), sites) if root and not isinstance(self.reference, DataFrame) else None

    def _digested(self, sites: frozenset[RestrictionSite]) -> tuple[DataFrame | None, DataFrame]:
        """Fragments (none without sites) and sequences: from the index if it holds them, else made and kept there."""
        index, chunks, reach = self._index(sites), self.chunks, digest.reach_of(sites)
        found = [index.get("fragments") if sites else None, index.get("sequences")] if index else [None, None]
        if found[1] is not None and (found[0] is not None or not sites):
            return found[0], found[1]
        frags = digest.fragments(chunks(), sites, reach) if sites else None
        sequences = digest.sequence_table(None if sites else chunks(), frags)
        if index:
            return index.put("fragments", frags) if sites else None, index.put("sequences", sequences)
        return frags, Workspace(self.spark, "sequences").table(sequences, "sequences")

    def aligned_digest(self) -> DataFrame:
        """The digest with filled overhangs: from the index if it holds it, else made (and kept there, if there is one)."""
        sites = self.sites()
        make = lambda: digest.aligner_digest(self.chunks(), sites, reach=digest.reach_of(sites))
        index = self._index(sites)
        return index.get_or_put("aligned", make) if index else make()

    def genome(self) -> DataFrame:
        """(seq_idx, name, seq) for an aligner: whole sequences, put together from chunks."""
        ref = self.reference
        if isinstance(ref, DataFrame):
            return ref
        parts = F.sort_array(F.collect_list(F.struct("chunk_start", "bases")))
        return self.chunks().groupBy("seq_idx", "name").agg(F.array_join(F.transform(parts, lambda x: x["bases"]), "").alias("seq"))

    def _align(self, reads: DataFrame, aligner: Aligner, trim: bool, keep_tags: list[str] | None = None) -> DataFrame:
        """Aligned records; with ``trim`` in two passes.

        The first aligns to the digest with filled overhangs, and primary records are clipped to their fragment;
        the second aligns what is left to the reference.  Without sites there is nothing to trim by.
        """
        if not trim or not self.sites():
            return aligner(reads, self.genome())
        cut = Workspace(self.spark, "trim").table(self.aligned_digest().filter("frag_end > frag_start"), "digest")
        first = aligner(reads, cut.select(F.monotonically_increasing_id().alias("seq_idx"), F.col("frag_name").alias("name"), F.col("bases").alias("seq")))
        part = F.split("rest", "\t")
        primary = first.filter(F.col("flag").bitwiseAND(0x900) == 0).withColumns({"seq": F.get(part, 3), "qual": F.get(part, 4)})
        frags = trimming.parse_fragment_names(cut.select(F.col("frag_name").alias("rname"), F.length("bases").cast("long").alias("length")))
        rest = F.concat_ws("\t", F.array_join(F.slice(part, 1, 3), "\t"), "seq", "qual", F.array_join(F.slice(part, 6, F.greatest(F.size(part) - 5, F.lit(0))), "\t"))
        left = trimming.trim(primary, frags).withColumn("rest", rest)
        return aligner(files.sam_to_fastq(left, keep_tags), self.genome())

    def output(self, name: str) -> DataFrame:
        """The tagged records of a class or of a group of classes."""
        return sinks.route(self.tagged, name)

    def run(self) -> Stats | None:
        try:
            return self._run()
        except Exception as error:
            if self.exception_callback:
                self.exception_callback(error)
            raise

    def _log(self, done: DataFrame) -> None:
        """Records of each class and their share, as a status line each."""
        counts = {r[0]: r[1] for r in done.groupBy("hc").count().collect()}
        total = sum(counts.values())
        for name, n in sorted(counts.items()):
            self.logger.info("%s: %d records (%.2f %%)", name, n, 100 * n / total)

    def _write_outputs(self, sites: frozenset[RestrictionSite], sequences: DataFrame) -> None:
        """One job over the records for each form of output, however many outputs there are."""
        forms: dict[tuple[str, bool], list[str]] = {}
        for path, (_, sort) in self._outputs.items():
            kind = path.rsplit(".", 1)[-1] if path.endswith((".sam", ".bam")) else "parquet"
            if kind == "sam" and sort:
                self.logger.warning("%s is text and stays unsorted", path)
            forms.setdefault((kind, sort and kind != "sam"), []).append(path)
        for (kind, sort), paths in forms.items():
            classes = [self._outputs[p][0] for p in paths]
            part = sinks.routed(self.tagged, classes)
            if sort:
                part = sinks.coordinate_sorted(part, sequences, ["route"])
            head = self._header
            if kind == "bam" and not any(x.startswith("@SQ") for x in head):
                lines = [f"@SQ\tSN:{r['name']}\tLN:{r['length']}" for r in sequences.orderBy("seq_idx").select("name", "length").toLocalIterator()]  # the form lists them all
                head = [x for x in head if x.startswith("@HD")] + lines + [x for x in head if not x.startswith("@HD")]
            if kind == "bam" and sort:
                fields = next((x.split("\t")[1:] for x in head if x.startswith("@HD")), ["VN:1.6"])
                head = ["\t".join(["@HD", *(f for f in fields if not f.startswith(("SO:", "GO:"))), "SO:coordinate"])] + [x for x in head if not x.startswith("@HD")]
            own = [[c for n in names for c in sinks.classes_of(n)] for names in classes]
            headers = [header.output_header(head, "@PG\tID:chromaloom\tPN:chromaloom", c, self.min_mapq, sites) for c in own]
            if kind == "sam":
                sinks.write_sams(part, headers, paths)
            elif kind == "bam":
                sinks.write_bams(part if sort else part.sortWithinPartitions("route"), headers, paths)
            else:
                sinks.write_parquets(part, paths, by_class=not sort)

    def _run(self) -> Stats | None:
        sites = self.sites()
        if self._index_only:
            if isinstance(self.reference, DataFrame):
                self.aligned_digest().write.mode("overwrite").parquet(f"{self._needed('save_stats_path')}/{digest.cache_key('table', sites)}/aligned")
            else:
                self._needed("index_path" if self.index_path else "save_stats_path")
                self.aligned_digest()
            return None
        if self._input is None:
            raise SettingError("no input is registered")
        frags, sequences = self._digested(sites)
        # The input is read, classified and paired once; outputs and statistics derive from this table.
        classified = reads.classify(self._input(), sequences, frags, self.min_mapq)
        done = Workspace(self.spark, "records").table(pairs.resolve(classified), "records")
        found = pairs.pairs_of(done)
        self._log(done)
        self.tagged = reads.tags(done.drop("pair"))
        self._write_outputs(sites, sequences)
        result = Stats(done, found, sequences, bool(self.dense_contacts))
        if self.save_stats_path:
            result.save(str(self.save_stats_path))
        return result
