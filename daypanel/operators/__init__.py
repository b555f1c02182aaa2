"""DataFrame-to-DataFrame operators over a panel of daily series."""
