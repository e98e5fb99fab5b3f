"""Named queries over the test tables (``catalog``, ``streams``) and their SQL oracle (``oracle``)."""
