"""Jobs: each moves one kind of data one step, sink first, watermark after."""
