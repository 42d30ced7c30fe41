"""DataFrame -> DataFrame operators. None of them starts a job, except
``neighbours``, which checkpoints its sliced rows."""
