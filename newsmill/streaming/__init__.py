"""newsmill.streaming"""
