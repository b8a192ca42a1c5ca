"""Dataset plans: bronze stand-ins, silver, gold, quality, sinks, serving, registry."""
