"""quillgraph: text corpora to grounded synthetic training tasks, as Spark DataFrame plans."""
