"""The registered queries, their oracles and the inputs they run on."""
