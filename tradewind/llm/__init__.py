"""Operators for training-data pipelines. Nothing outside this folder imports it.

Every operator takes a frame with an id and a text column (``doc_id`` and ``text`` unless told
otherwise), reads only those two, and returns only the columns its docstring names, so other
columns of the input can neither be lost nor clash.
"""
