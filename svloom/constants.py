"""Fixed values of the call-consolidation rules: caller names, their order and the default limits."""

#: Callers in order of trust.
CALLERS = ("Pindel", "BreakSeq", "HaplotypeCaller", "BreakDancer", "CNVnator", "Manta", "Lumpy", "WHAM", "CNVkit")
PRECISE_CALLERS = ("Pindel", "BreakSeq", "HaplotypeCaller", "SoftClip")
#: Evidence that each caller uses: SR split read, JM junction mapping, RP read pair, RD depth, AS assembly, SC soft clip.
METHODS = {
    "Pindel": ("SR",),
    "BreakSeq": ("JM",),
    "HaplotypeCaller": ("AS",),
    "BreakDancer": ("RP",),
    "CNVnator": ("RD",),
    "Manta": ("SR", "RP"),
    "Lumpy": ("SR", "RP"),
    "WHAM": ("SR", "RP"),
    "CNVkit": ("RD",),
    "SoftClip": ("SC",),
}
#: Types that each caller's own format may report.
CALLER_TYPES = {"BreakDancer": ("DEL", "INS", "INV", "ITX", "CTX"), "Pindel": ("DEL", "INS", "INV", "DUP"), "CNVnator": ("DEL", "DUP"), "BreakSeq": ("DEL", "INS")}
#: Order in which a type is chosen where several are packed together.
TYPE_ORDER = ("DEL", "INV", "DUP", "ITX", "CTX", "INS")
TRANSLOCATIONS = ("ITX", "CTX")
FILTERED_CALLERS = ("BreakSeq", "Lumpy", "Manta", "CNVkit", "WHAM")

MIN_SV_LENGTH = 50
MAX_SV_LENGTH = 1_000_000
OVERLAP_RATIO = 0.5
WIGGLE = 100
INS_WIGGLE = 100
TX_WIGGLE = 5

READ_LENGTH = 100
ISIZE_MEAN = 350
ISIZE_SD = 50
COVERAGE = 50
MIN_SUPPORT_SC_ONLY = 2
MIN_SUPPORT = {"INS": 15, "DEL": 10, "INV": 10, "DUP": 10}
MIN_SUPPORT_FRAC = {"INS": 0.05, "DEL": 0.04, "INV": 0.015, "DUP": 0.015}
INS_COVERAGE_FRAC = (0.5, 1.5)
MAX_INTERVALS = 10_000
SC_PAD = 500
MIN_SOFT_CLIP = 20
MIN_BASE_QUAL = 20
MIN_MAPQ = 5
MAX_NM = 10
MIN_MATCHES = 50
OTHER_SCALE = 5
MAX_PAIRS = 10_000
GT_WINDOW = 100
GT_FRAC = 0.05
ASM_MAX_SIZE = {"INS": 50_000}
ASM_MAX_SIZE_OTHER = 1_000_000
