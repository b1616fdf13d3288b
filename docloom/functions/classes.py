"""Character classes that mean in Java, and in Arrow's kernels, what Python's Unicode-aware \\s, \\w and \\d mean. Word characters and digits are spelled alike in both."""

#: White space, word characters and digits, as contents of a bracket expression.
WS_CHARS = r"\t-\r\x1c-\x20\x85\p{Z}"
W_CHARS = r"\p{L}\p{N}_"

WS = f"[{WS_CHARS}]"
NOT_WS = f"[^{WS_CHARS}]"
W = f"[{W_CHARS}]"
D = r"\p{Nd}"
#: Characters at which str.splitlines() splits, as contents of a bracket expression.
LINE_BREAK_CHARS = r"\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029"
#: The same in the spelling of Arrow's kernels.
KERNEL_WS_CHARS = r"\t-\r\x1c-\x20\x{85}\p{Z}"
KERNEL_WS, KERNEL_W = f"[{KERNEL_WS_CHARS}]", W
