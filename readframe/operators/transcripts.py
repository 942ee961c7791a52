"""Transcript candidates from splice evidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from readframe.functions.text import transcript_id
from readframe.operators.intervals import BIN_STEP, islands
from readframe.operators.scale import salted_join
from readframe.session import settle

MIN_INTRON_SUPPORT = 2
LISTED = 8  # introns of a chain that names its parts, 35 at most


def splice_fragments(splices: DataFrame, keys: Sequence[str] = ("read_id",)) -> DataFrame:
    """One row per fragment with its ordered introns, from one row per splice.

    Equal splices of a fragment (copies in two tiles) merge; the set is bounded by the
    introns one fragment can cross.
    """
    return splices.groupBy(*keys, "chrom_id", "strand").agg(
        F.array_sort(F.collect_set(F.struct(F.col("intron_s").alias("s"), F.col("intron_e").alias("e")))).alias("chain")
    )


def chains(frags: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Distinct intron chains: ``(chrom_id, strand, chain, support, start0, end0)``.

    Support counts fragments, so ``frags`` must hold each fragment once. Without read ends the
    chain reaches from its first to its last intron.
    """
    low = F.col(start) if start else F.col("chain")[0]["s"]
    high = F.col(end) if end else F.element_at("chain", -1)["e"]
    return frags.filter(F.size("chain") > 0).groupBy("chrom_id", "strand", "chain").agg(
        F.count("*").alias("support"), F.min(low).alias("start0"), F.max(high).alias("end0")
    )


def intron_support(chain_table: DataFrame) -> DataFrame:
    """Fragments over each intron, from the distinct chains and not from the reads."""
    return chain_table.select("chrom_id", "strand", F.explode("chain").alias("intron"), "support").groupBy(
        "chrom_id", "strand", "intron"
    ).agg(F.sum("support").alias("intron_support"))


def supported_chains(chain_table: DataFrame, minimum: int = MIN_INTRON_SUPPORT) -> DataFrame:
    """Chains of which every intron is supported by at least ``minimum`` fragments."""
    # Three uses of a table that is small next to the reads behind it.
    chain_table = settle(chain_table)
    weak = intron_support(chain_table).filter(F.col("intron_support") < minimum)
    keys = ["chrom_id", "strand", "intron"]
    members = chain_table.select("chrom_id", "strand", "chain", F.explode("chain").alias("intron"))
    # An intron of a busy gene is in many chains; the weak introns are copied to salt slices.
    broken = salted_join(members, weak.select(*keys), keys, "left_semi", salts=8).select(
        "chrom_id", "strand", "chain"
    ).distinct()
    return chain_table.join(broken, ["chrom_id", "strand", "chain"], "left_anti")


def _points(chain_table: DataFrame) -> DataFrame:
    """``(id, i, intron, mark)``: a chain's introns in order, then one row without; ``mark`` is the fingerprint of all before."""
    ended = F.concat("chain", F.array(F.lit(None).cast(chain_table.schema["chain"].dataType.elementType)))
    rows = chain_table.select("id", "chrom_id", "strand", F.posexplode(ended).alias("i", "intron"))
    before = Window.partitionBy("id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("mark", F.coalesce(F.bit_xor(F.xxhash64("intron.s", "intron.e")).over(before), F.lit(0)))


def contained(small: DataFrame, large: DataFrame, proper: bool = False) -> DataFrame:
    """``small_id, large_id``: chains of ``small`` that are a contiguous part of a chain of ``large``.

    Both: ``(id, chrom_id, strand, chain)``. A chain's introns differ, so a part of it is known by its first intron and its
    length, and its fingerprint is what two running fingerprints differ by. A large chain looks only at the lengths that
    small chains have at its introns; no chain lists its parts and no two chains of a gene are compared unless their
    fingerprints agree, which is then verified. With ``proper`` a part is shorter than the whole.
    """
    kind = F.struct(F.col("chain")[0].alias("first"), F.size("chain").alias("n")).alias("k")
    small = small.filter(F.size("chain") > 0).select("id", "chrom_id", "strand", "chain", kind)
    mark = F.aggregate("chain", F.lit(0).cast("bigint"), lambda x, i: x.bitwiseXOR(F.xxhash64(i["s"], i["e"])))
    small = small.select(F.col("id").alias("small_id"), "chrom_id", "strand", F.col("chain").alias("small_chain"), "k.first", "k.n", mark.alias("fp"))
    points = settle(_points(large.filter(F.size("chain") > (1 if proper else 0))))
    lengths = small.groupBy("chrom_id", "strand", F.col("first").alias("intron")).agg(F.collect_set("n").alias("lengths"))
    begins = points.join(lengths, ["chrom_id", "strand", "intron"]).select(
        "id", "chrom_id", "strand", F.col("intron").alias("first"), F.col("i").alias("begin"), F.col("mark").alias("from"), F.explode("lengths").alias("n")
    )
    ends = points.select("id", F.col("i").alias("end"), F.col("mark").alias("to"))
    spans = begins.withColumn("end", F.col("begin") + F.col("n")).join(ends, ["id", "end"])
    spans = spans.withColumn("fp", F.col("from").bitwiseXOR(F.col("to")))
    found = spans.join(small, ["chrom_id", "strand", "first", "n", "fp"]).select("small_id", "small_chain", "n", "begin", F.col("id").alias("large_id"))
    whole = found.join(large.select(F.col("id").alias("large_id"), "chain"), "large_id")
    same = F.slice("chain", F.col("begin") + 1, F.col("n")) == F.col("small_chain")
    if proper:
        same &= F.col("n") < F.size("chain")
    return whole.filter(same).select("small_id", "large_id").distinct()


def with_chain_id(chain_table: DataFrame) -> DataFrame:
    return chain_table.withColumn("id", F.xxhash64("chrom_id", "strand", "chain"))


def listed_parts(chain: Column) -> Column:
    """All contiguous parts of a chain that are shorter than it."""
    n = F.size(chain)
    begins = F.when(n > 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    longest = lambda i: F.least(n - i + 1, n - 1)
    return F.flatten(F.transform(begins, lambda i: F.transform(F.sequence(F.lit(1), longest(i)), lambda size: F.slice(chain, i, size))))


def drop_contained(chain_table: DataFrame, keep: Column | None = None, listed: int = LISTED) -> DataFrame:
    """Drop chains that are a contiguous part of another chain. Rows for which ``keep`` holds stay in any case.

    A chain of up to ``listed`` introns names its parts; what is part of a longer one is found by fingerprints. No two
    chains of a gene are compared with each other.
    """
    keys = ["chrom_id", "strand", "chain"]
    chain_table = settle(chain_table)
    short = chain_table.filter(F.size("chain").between(2, listed))
    parts = short.select("chrom_id", "strand", F.explode(listed_parts(F.col("chain"))).alias("chain"))
    long = chain_table.filter(F.size("chain") > listed)
    if not long.isEmpty():
        rows = with_chain_id(chain_table.select(*keys))
        large = with_chain_id(long.select(*keys)).distinct()
        inside = contained(rows, large.select(*[F.col(c).alias(c) for c in large.columns]), proper=True)
        parts = parts.unionByName(rows.join(inside.select(F.col("small_id").alias("id")), "id", "left_semi").select(*keys))
    joined = chain_table.join(parts.distinct().withColumn("_part", F.lit(True)), keys, "left")
    survives = F.col("_part").isNull()
    return joined.filter(survives if keep is None else survives | keep).drop("_part")


def single_exon_islands(blocks: DataFrame) -> DataFrame:
    """Stretches covered by reads without a splice, in the shape of :func:`chains`."""
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")
    found = islands(blocks, ["chrom_id", "strand"]).withColumn("chain", none)
    return found.select("chrom_id", "strand", "chain", F.lit(0).cast("bigint").alias("support"), "start0", "end0")


def transcript_strand(alignments: DataFrame) -> DataFrame:
    """``strand`` of the transcript: the aligner's ``XS`` tag where there is one, else the read's own."""
    if "tags" not in alignments.columns:
        return alignments
    return alignments.withColumn("strand", F.coalesce(F.try_element_at("tags", F.lit("XS")), "strand"))


def fragment_chains(alignments: DataFrame) -> DataFrame:
    """One row per fragment: the introns of all mates of one ``(sample, read_id)`` on a chromosome and strand, and their span.

    The list is bounded by the introns that one fragment can cross.
    """
    keys = ["sample", "read_id"] if "sample" in alignments.columns else ["read_id"]
    introns = F.array_sort(F.array_distinct(F.flatten(F.collect_list("introns")))).alias("chain")
    return alignments.filter(F.size("introns") > 0).groupBy(*keys, "chrom_id", "strand").agg(
        introns, F.min("start0").alias("start0"), F.max("end0").alias("end0")
    )


def transcript_candidates(alignments: DataFrame, minimum: int = MIN_INTRON_SUPPORT) -> DataFrame:
    """A15 from alignments with ``(read_id, chrom_id, strand, start0, end0, introns)`` and perhaps ``sample``.

    Evidence is counted in fragments, so mates over one intron count once and equal ids of two samples twice.
    """
    stranded = transcript_strand(alignments)
    table = drop_contained(supported_chains(chains(fragment_chains(stranded), "start0", "end0"), minimum))
    return table.unionByName(single_exon_islands(stranded.filter(F.size("introns") == 0)))


def with_exon_length(table: DataFrame) -> DataFrame:
    """Adds ``length``: bases of the span that are not in introns."""
    inner = F.aggregate("chain", F.lit(0).cast("bigint"), lambda total, i: total + i["e"] - i["s"])
    return table.withColumn("length", F.col("end0") - F.col("start0") - inner)


def abundance(table: DataFrame, read_length: int = 100) -> DataFrame:
    """Coverage, FPKM and TPM of transcripts with ``support`` and ``length``."""
    # The totals and the rows both read the table, which is small next to the reads behind it.
    table = settle(table)
    rate = F.col("support") / F.col("length")
    sums = table.agg(F.sum("support").alias("reads"), F.sum(rate).alias("rates"))
    reads, rates = sums.select("reads").scalar(), sums.select("rates").scalar()
    return table.select(
        "*",
        (F.col("support") * read_length / F.col("length")).alias("cov"),
        (F.col("support") * 1e9 / (F.col("length") * reads)).alias("fpkm"),
        (rate / rates * 1e6).alias("tpm"),
    )


def fragment_classes(chain_table: DataFrame, table: DataFrame) -> DataFrame:
    """``transcripts, fragments``: how many fragments are compatible with just this set of transcripts.

    A fragment is compatible with a transcript whose chain its own is a part of. ``chain_table`` has the distinct
    chains of the fragments with their ``support``, ``table`` the transcripts with an ``id``. Chains of no transcript
    are left out. The set is bounded by the isoforms of a gene.
    """
    own = with_chain_id(chain_table)
    found = contained(own, table).withColumnRenamed("small_id", "id").groupBy("id").agg(F.sort_array(F.collect_set("large_id")).alias("transcripts"))
    return found.join(own.select("id", "support"), "id").groupBy("transcripts").agg(F.sum("support").alias("fragments"))


def shared_abundance(chain_table: DataFrame, table: DataFrame, steps: int = 20, read_length: int = 100) -> DataFrame:
    """A16 where fragments fit several transcripts: ``table`` with ``reads``, ``cov``, ``fpkm`` and ``tpm``.

    Expectation-maximisation over the classes of :func:`fragment_classes`: each step deals a class's fragments to its
    transcripts in proportion to their reads per base so far, then sums them by transcript. Steps see classes, not
    fragments; the work of one is a join, a window and an aggregation of (class, transcript) rows. ``table`` has distinct chains and
    ``length``; a transcript that no fragment fits has 0 reads.
    """
    table = settle(with_chain_id(table))
    classes = fragment_classes(chain_table, table).withColumn("class", F.xxhash64("transcripts"))
    pairs = settle(
        classes.select("class", "fragments", F.explode("transcripts").alias("id")).join(table.select("id", "length"), "id")
    )
    reads = table.select("id", F.lit(1.0).alias("reads"))
    # A class has as many rows as a gene has isoforms, so a window sees few.
    total = F.sum("weight").over(Window.partitionBy("class"))
    for step in range(steps):
        weighed = pairs.join(reads, "id").withColumn("weight", F.col("reads") / F.col("length"))
        dealt = weighed.select("id", (F.col("fragments") * F.col("weight") / total).alias("part"))
        reads = settle(dealt.groupBy("id").agg(F.sum("part").alias("reads")))
    counted = settle(table.join(reads, "id", "left").withColumn("reads", F.coalesce("reads", F.lit(0.0))).drop("id"))
    rate = F.col("reads") / F.col("length")
    sums = counted.agg(F.sum("reads").alias("reads"), F.sum(rate).alias("rates"))
    all_reads, rates = sums.select("reads").scalar(), sums.select("rates").scalar()
    return counted.select(
        "*",
        (rate * read_length).alias("cov"),
        (F.col("reads") * 1e9 / (F.col("length") * all_reads)).alias("fpkm"),
        (rate / rates * 1e6).alias("tpm"),
    )


def merge_with_reference(candidates: DataFrame, reference: DataFrame) -> DataFrame:
    """Candidates of all bins with the reference transcripts.

    Equal chains collapse, contained ones go, reference transcripts always stay (and bring
    their id). Both inputs: ``(chrom_id, strand, chain, support, start0, end0)``, the
    reference with ``tid`` and ``support`` 0. Single-exon transcripts are kept by coordinates.
    """
    keys = ["chrom_id", "strand", "chain"]
    both = candidates.withColumn("tid", F.lit(None).cast("string")).unionByName(
        reference.withColumn("support", F.lit(0).cast("bigint")).select(
            *keys, "support", "start0", "end0", "tid"
        )
    )
    spliced = both.filter(F.size("chain") > 0).groupBy(*keys).agg(
        F.sum("support").cast("bigint").alias("support"),
        F.min("start0").alias("start0"),
        F.max("end0").alias("end0"),
        F.min("tid").alias("tid"),
    )
    single = both.filter(F.size("chain") == 0).groupBy(*keys, "start0", "end0").agg(
        F.sum("support").cast("bigint").alias("support"), F.min("tid").alias("tid")
    )
    return drop_contained(spliced, F.col("tid").isNotNull()).unionByName(single)


def with_bin(table: DataFrame) -> DataFrame:
    """The bin a transcript starts in."""
    return table.withColumn("bin", F.expr(f"start0 div {BIN_STEP}"))


def name_transcripts(table: DataFrame, chroms: DataFrame) -> DataFrame:
    """``tid`` = chromosome, bin and the transcript's own coordinates.

    The coordinates number transcripts without any order over the bin. A hash of the chain
    tells isoforms with equal ends apart.
    """
    from readframe.operators.intervals import add_chromosome_name

    number = F.concat_ws(
        "_", F.col("start0").cast("string"), F.col("end0").cast("string"), F.hex(F.xxhash64("strand", "chain"))
    )
    named = add_chromosome_name(with_bin(table), chroms)
    return named.withColumn("tid", transcript_id(F.col("chrom"), F.col("bin"), number))


def bin_order(table: DataFrame) -> DataFrame:
    """O3: for sinks."""
    return table.orderBy("chrom_id", "bin", "start0")


def coordinate_sorted(binned: DataFrame, partitions: int | None = None) -> DataFrame:
    """Reads of a bin in coordinate order.

    The range split looks at the start as well, so a deep bin is cut into several tasks.
    """
    order = ["chrom_id", "bin", "start0"]
    ranged = binned.repartitionByRange(partitions, *order) if partitions else binned.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def transcript_exons(table: DataFrame) -> DataFrame:
    """Exons of transcripts: the span without its introns, ``(<id columns>, exon_no, start0, end0)``."""
    starts = F.concat(F.array(F.col("start0")), F.transform("chain", lambda i: i["e"]))
    ends = F.concat(F.transform("chain", lambda i: i["s"]), F.array(F.col("end0")))
    exons = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e")))
    rest = [c for c in table.columns if c not in ("start0", "end0")]
    return (
        table.select(*rest, F.posexplode(exons).alias("exon_no", "_x"))
        .select(*rest, "exon_no", F.col("_x.s").alias("start0"), F.col("_x.e").alias("end0"))
    )


def chains_of_exons(exons: DataFrame, key: str = "tid") -> DataFrame:
    """Reference transcripts as chains, from exon rows ``(tid, chrom_id, strand, start0, end0)``."""
    sorted_exons = F.array_sort(F.collect_set(F.struct(F.col("start0").alias("s"), F.col("end0").alias("e"))))
    grouped = exons.groupBy(key, "chrom_id", "strand").agg(sorted_exons.alias("_x"))
    chain = F.transform(
        F.when(F.size("_x") > 1, F.sequence(F.lit(1), F.size("_x") - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(F.get("_x", i - 1)["e"].alias("s"), F.get("_x", i)["s"].alias("e")),
    )
    return grouped.select(
        F.col(key).alias("tid"),
        "chrom_id",
        "strand",
        chain.alias("chain"),
        F.col("_x")[0]["s"].alias("start0"),
        F.element_at("_x", -1)["e"].alias("end0"),
    )
