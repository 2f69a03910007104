"""Jobs: one function per product, from processed trips to written artefacts."""
