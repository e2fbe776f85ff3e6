"""Operators of a training-data pipeline: near copies, archives, packing, licences, mixing, chat, classifiers, search."""
