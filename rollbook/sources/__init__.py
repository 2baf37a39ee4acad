"""Reading and writing: declared sources, header rules, sinks, checkpoints."""
