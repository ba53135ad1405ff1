"""Fixed values.

These patterns and lists define the token grains and the label rules; they
must stay exactly as written for results to match.  All patterns are valid
both as Java regex (Spark) and RE2 (the DuckDB oracle); blanks are spelled out
as an explicit class because ``\\s`` differs between the two engines.
"""

# --- fixed values -----------------------------------------------------------
BLANKS = r"\t\n\x0B\f\r "

# Word grain: letter runs, digit runs, a newline, or one other non-blank mark.
WORD_RE = r"\p{L}+|\p{N}+|\n|[^\p{L}\p{N}\t\n\x0B\f\r ]"

# Segment grain for BPE: an optional leading space glued to a letter run,
# digit run or mark run, or a run of blanks.  Pieces rebuild the text exactly.
SEG_RE = r" ?\p{L}+| ?\p{N}+| ?[^\p{L}\p{N}\t\n\x0B\f\r ]+|[\t\n\x0B\f\r ]+"

UPPER_RE = r"^\p{Lu}"            # first character is an uppercase letter
ALPHA_RE = r"\A\p{L}+\z"         # every character is a letter
BOUNDARY_RE = r"[.!?\n]\z"       # token ends a sentence (or a line)
BOUNDARY_CHARS = [".", "!", "?", "\n"]  # the same test as a last-character lookup
CAPWORD_RE = r"\A\p{Lu}\p{L}*\z"  # UPPER_RE and ALPHA_RE in one pass

# Line breaks recognised when a text is split into lines.
LINE_BREAK = r"[\n\r\x0B\f\x1C\x1D\x1E\x{0085}\x{2028}\x{2029}]"
LINE_RE = r"\r\n|" + LINE_BREAK
# Unicode blanks stripped from both ends of a line.
WS_CLASS = r"[\t\n\x0B\f\r \x1C-\x1F\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# The same as characters, to be trimmed without a pattern.
WS_CHARS = "\t\n\x0B\f\r \x1C\x1D\x1E\x1F\x85\xA0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202F\u205F\u3000"
STRIP_RE = r"\A" + WS_CLASS + r"+|" + WS_CLASS + r"+\z"

# Label names by id: 0 outside, 1 begins an entity, 2 continues one.
LABEL_NAMES = ["O", "B-ENT", "I-ENT"]

# Kappa reading: strictly above each bound, first match wins (words as published).
KAPPA_BANDS = [(0.80, "excelente"), (0.60, "bueno"), (0.40, "moderado")]
KAPPA_FLOOR = "débil"
KAPPA_PREFIX = "acuerdo "

# Display of vocabulary entries: newline shown as backslash-n, space as U+2581.
PRETTY_SPACE = "▁"

# Packed-id alphabet for BPE: private-use code points, first those of the basic plane, then planes 15 and 16.
PACK_RANGES = [(0xE000, 0xF8FF), (0xF0000, 0xFFFFD), (0x100000, 0x10FFFD)]
