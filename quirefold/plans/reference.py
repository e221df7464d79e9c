"""The queries of the document-pipeline operators and their SQL, from the modules beside this one."""

from __future__ import annotations

from quirefold.plans import boxes, catalog, documents, edges, pipeline, services, texts

QUERIES = {**catalog.QUERIES, **texts.QUERIES, **boxes.QUERIES, **edges.QUERIES, **pipeline.QUERIES, **services.QUERIES, **documents.QUERIES}
SQL = {**catalog.SQL, **texts.SQL, **boxes.SQL, **edges.SQL, **pipeline.SQL, **services.SQL, **documents.SQL}
