"""Entity resolution and registry analytics as Spark plans."""
