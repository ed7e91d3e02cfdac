"""Thresholds of the operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    """Defaults follow the tool's documented options.

    ``compat`` keeps behaviour that programs rely on although names and help
    say otherwise; without it the operators do what the names say.
    """

    compat: bool = True
    # Best alignment of a read.
    min_coverage: float = 0.67
    min_identity: float = 0.75
    max_second: float = 0.98
    min_introns: int = 0
    # Exons and introns of an alignment.
    min_exon: int = 3
    min_intron: int = 3
    max_deletion: int = 50
    # Comparison with the annotation.
    site_distance: int = 0
    end_distance: int = 2**31 - 1
    single_overlap: float = 0.80
    full_level: int = 5
    force_strand: bool = False
    # Junction evidence.
    use_multi: bool = False
    min_junction_count: int = 1
    split: bool = False
    # Fusions.
    part_overlap: float = 0.1
    part_coverage: float = 0.1
    total_coverage: float = 0.99
    part_distance: int = 100_000
