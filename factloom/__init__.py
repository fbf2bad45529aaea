"""Factloom: documents and web pages into a traceable table of facts, as Spark plans."""
