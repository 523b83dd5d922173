"""granary.streaming"""
