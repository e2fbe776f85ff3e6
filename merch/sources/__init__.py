"""Landed feeds (workbooks, paged tables, freight JSON, grids) and table writers."""
