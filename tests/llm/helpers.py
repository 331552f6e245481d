def table(frame):
    """The rows, in one order."""
    return sorted(map(tuple, frame.collect()), key=repr)
