"""Column functions: text, timecodes, extraction patterns, URLs, and cells that hold lists or maps."""
