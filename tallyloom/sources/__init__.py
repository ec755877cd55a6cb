"""File formats. Parsers take tables of lines, so that they run on any storage; readers find the lines.

Text formats go through Spark's own text source. Formats whose records span lines, or that are binary, are streamed file
by file inside tasks, in constant memory: one task per file, as such data come in many files.
"""
